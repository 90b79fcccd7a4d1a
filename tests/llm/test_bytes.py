"""Exact dedup, Ogg media, WARC and BPE."""

from __future__ import annotations

import base64
import gzip
import hashlib
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docgraph.llm import bpe, exact_dedup, ogg, queries, warc
from tests.llm.helpers import LONG, ODD_ROWS, by_id, docs, table

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


# --- exact dedup -------------------------------------------------------------------


def test_exact_dedup_of_one_id_with_several_texts(spark):
    found = exact_dedup.exact_dedup(docs(spark, [(1, "a"), (1, "b"), (2, "a")])).collect()
    assert sorted((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in found) == [(1, 1, 1, True), (1, 2, 2, False), (2, 2, 2, True)]


@pytest.mark.parametrize(("key_bits", "capacity"), [(64, 512), (3, 1), (1, 2)])
def test_exact_dedup_equals_brute_force(spark, key_bits, capacity):
    rng = random.Random(1)
    texts = [(i, rng.choice(["a", "b", "", None, "c" * 50, *map(str, range(30))])) for i in range(300)]
    found = exact_dedup.exact_dedup(docs(spark, texts), capacity, key_bits).collect()
    groups: dict[str, list[int]] = {}
    for i, t in texts:
        groups.setdefault(t or "", []).append(i)
    want = {(i, max(groups[t or ""]), len(groups[t or ""]), i == max(groups[t or ""]), sha(t)) for i, t in texts}
    assert {tuple(r) for r in found} == want
    assert len(found) == 300


def test_index_is_read_through_its_directory(spark, tmp_path):
    texts = [(i, f"text {i % 150}") for i in range(200)]
    index = exact_dedup.build_index(docs(spark, texts), f"file://{tmp_path}", capacity=2)
    buckets = [(r["owner"], r["depth"], r["bucket"]) for r in index.directory.collect()]
    assert len(buckets) > 60 and len({d for _, d, _ in buckets}) > 1
    for owner, depth, prefix in buckets:  # no bucket's slots are another's
        assert sum(o == owner and (prefix ^ p) & ((1 << min(d, depth)) - 1) == 0 for o, d, p in buckets) == 1
    entries = index.entries.collect()
    assert all(r["bucket"] == r["h"] & ((1 << r["depth"]) - 1) for r in entries) and len(entries) == 150
    asked = docs(spark, [(1000, "text 7"), (1001, "text 170"), (1002, "unknown"), (1003, None)])
    assert [(r["doc_id"], r["keep_id"], r["group_size"]) for r in index.find(asked).collect()] == [(1000, 157, 2)]


def test_exact_dedup_odd_rows(spark):
    found = exact_dedup.exact_dedup(table(spark, ODD_ROWS)).collect()
    assert len(found) == len(ODD_ROWS)
    empty = [r for r in found if r["text_sha256"] == sha("")]
    assert {r["doc_id"] for r in empty} == {1, 2, None}
    assert all(r["keep_id"] == 2 and r["group_size"] == 3 for r in empty)
    assert [r["kept"] for r in found if r["doc_id"] == 6] == [True, True]  # the same document twice
    lone = next(r for r in found if r["doc_id"] is None and r["text_sha256"] != sha(""))
    assert lone["keep_id"] is None and lone["kept"]
    assert exact_dedup.exact_dedup(table(spark, [])).count() == 0


def test_directory_doubles_only_for_deep_buckets():
    index = exact_dedup.ExtendibleHash(capacity=2)
    for key in (0b000, 0b001, 0b010, 0b100):
        index.insert(key, b"%d" % key, key, 1)
    assert len(index.directory) == 1 << index.depth
    for slot, bucket in enumerate(index.directory):
        assert slot & ((1 << bucket.depth) - 1) == bucket.prefix
        assert all(k & ((1 << bucket.depth) - 1) == bucket.prefix for k in bucket.chains)
    assert max(b.depth for b in index.buckets()) == index.depth > min(b.depth for b in index.buckets())


def test_equal_keys_chain_and_never_split_forever():
    index = exact_dedup.ExtendibleHash(capacity=1)
    for i in range(20):
        index.insert(5, b"%d" % i, i, 1)
    index.insert(5, b"3", 99, 4)
    assert index.depth == 0 and len(index.directory[0].chains[5]) == 20
    assert [b"3", 99, 5] in index.directory[0].chains[5]


# --- Ogg -----------------------------------------------------------------------------


def crc_bit_by_bit(data: bytes) -> int:
    r = 0
    for x in data:
        r ^= x << 24
        for _ in range(8):
            r = (r << 1) ^ 0x104C11DB7 if r & 0x80000000 else r << 1
    return r


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 140_000), st.randoms())
def test_ogg_round_trip(size, rng):
    text = rng.randbytes(size)
    payload = text.ljust(max(192, -(-size // 192) * 192), b" ")
    media = ogg.encode(payload, size)
    back, n, features = ogg.decode(media)
    assert (back, n) == (payload, size)
    assert features["duration_ms"] == len(payload) * 1000 // 8000


def test_ogg_checksum_is_the_formats_own():
    page = ogg.encode(b"x" * 192, 5)[: 27 + 1 + 15]
    assert ogg.page_checksum(page) == crc_bit_by_bit(page[:22] + b"\0\0\0\0" + page[26:])


def test_ogg_packets_run_over_pages():
    media = ogg.encode(b"y" * 192 * 600, 1)
    streams = ogg.demultiplex(media)
    samples = streams[ogg.SAMPLES]
    assert samples.pages > 2 and set(map(len, samples.packets[1:])) == {ogg.PACKET}
    granules = [g for g, _ in samples.marks]
    assert granules == sorted(granules) and granules[-1] == 192 * 600


def multiplexed(rng, packets):
    """Streams of packets (by serial number) in pages of random sizes, which take turns at random."""
    waiting = {}
    for serial, own in packets.items():
        lacing = b"".join(b"\xff" * (len(p) // 255) + bytes([len(p) % 255]) for p in own)
        body, at, cuts = b"".join(own), 0, []
        while at < len(lacing):
            cuts.append(lacing[at : at + rng.randint(1, 9)])
            at += len(cuts[-1])
        pages, place, continued = [], 0, 0
        for number, lace in enumerate(cuts):
            end = place + sum(lace)
            flags = continued | (ogg.FIRST if not number else 0) | (ogg.LAST if number == len(cuts) - 1 else 0)
            pages.append(ogg._page(flags, end, serial, number, lace, body[place:end]))
            place, continued = end, ogg.CONTINUED if lace[-1] == 255 else 0
        waiting[serial] = pages
    out = []
    while any(waiting.values()):
        out.append(waiting[rng.choice([s for s, pages in waiting.items() if pages])].pop(0))
    return b"".join(out)


@pytest.mark.parametrize("seed", range(8))
def test_ogg_streams_that_take_turns_are_told_apart(seed):
    rng = random.Random(seed)
    packets = {serial: [rng.randbytes(rng.choice([0, 1, 254, 255, 256, 700, 3000])) for _ in range(rng.randint(1, 12))] for serial in (7, 8, 9)}
    streams = ogg.demultiplex(multiplexed(rng, packets))
    assert {serial: s.packets for serial, s in streams.items()} == packets


def test_ogg_pages_of_stored_texts_alternate():
    media = ogg.encode(b"y" * 192 * 1800, 1)
    serials = [int.from_bytes(media[m.start() + 14 : m.start() + 18], "little") for m in re.finditer(b"OggS\0", media)]
    assert serials[3:] == [ogg.SAMPLES, ogg.META] * ((len(serials) - 3) // 2) and len(serials) > 12


@pytest.mark.parametrize("at", [0, 5, 30, 100, 2000])
def test_ogg_damage_is_found(at):
    media = bytearray(ogg.encode(b"z" * 192 * 20, 3))
    media[at] ^= 0x10
    with pytest.raises(ValueError):
        ogg.decode(bytes(media))


def test_ogg_query_values(spark):
    rows = ogg.read(ogg.store(table(spark, ODD_ROWS))).collect()
    assert len(rows) == len(ODD_ROWS) and all(r["error"] is None for r in rows)
    for text, row in ((t, next(r for r in rows if r["doc_id"] == i)) for i, t, *_ in ODD_ROWS if i is not None):
        body = (text or "").encode()
        payload = body.ljust(max(192, -(-len(body) // 192) * 192), b" ")
        assert row["n_bytes"] == len(body) and row["payload_bytes"] == len(payload)
        assert row["payload_sha256"] == hashlib.sha256(payload).hexdigest()
        assert row["tail_crc32"] == zlib.crc32(payload[-16:])
    same = [r for r in rows if r["doc_id"] in (5, 6)]
    assert len({r["media_sha256"] for r in same}) == 1
    assert ogg.read(ogg.store(table(spark, []))).count() == 0
    broken = spark.createDataFrame([(1, bytearray(b"no media")), (2, None)], "doc_id long, media binary")
    assert [r["error"] for r in sorted(ogg.read(broken).collect())] == ["truncated page header", "unknown logical streams"]


# --- WARC ------------------------------------------------------------------------------


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, digest string, payload string")


def test_warc_captures(spark):
    big, other = "<p>" + "q" * 200, "<p>" + "r" * 300
    rows = [(5, "http://a/5", big), (3, "http://a/3", big), (9, "http://b\r\n/9", big), (1, "u", "tiny"), (2, "u", "tiny"), (4, None, None), (7, "v", other), (7, "v", other), (None, "w", big)]
    captures = warc.warc_captures(pages(spark, rows), with_payload=True).collect()
    assert len(captures) == len(rows)
    ids = {c["capture"]["response"]["record_id"]: c["capture"]["metadata"]["fields"]["page-id"] for c in captures if c["capture"]["response"]["type"] == "response"}
    got = sorted(((c["capture"]["metadata"]["fields"]["page-id"], c["capture"]["response"]["type"], ids.get(c["capture"]["response"]["refers_to"])) for c in captures), key=str)
    assert got == sorted([("5", "revisit", "3"), ("3", "response", None), ("9", "revisit", "3"), ("1", "response", None), ("2", "response", None), ("4", "response", None), ("7", "response", None), ("7", "response", None), ("", "revisit", "3")], key=str)
    for c in captures:
        capture = c["capture"]
        assert capture["request"]["url"] == capture["response"]["url"] == capture["metadata"]["url"]
        if capture["response"]["type"] == "response":
            payload = bytes(capture["response"]["payload"])
            assert hashlib.sha256(payload).hexdigest() == capture["response"]["digest"]
            assert capture["response"]["payload_bytes"] == len(payload)
        else:
            assert capture["response"]["payload"] is None and capture["response"]["digest"] == sha(big)
    assert warc.warc_captures(pages(spark, [])).count() == 0


def test_warc_keeps_odd_bytes_and_long_pages(spark):
    rows = [(1, "u", "WARC/1.1\r\n\r\nContent-Length: 7\r\n\r\nWARC/1.1\r\n" * 20), (2, "u", LONG), (3, "u", "\x00😀 \r\n\r\n")]
    captures = warc.warc_captures(pages(spark, rows), with_payload=True).collect()
    assert {c["capture"]["metadata"]["fields"]["page-id"]: bytes(c["capture"]["response"]["payload"]).decode() for c in captures} == {str(i): h for i, _, h in rows}


def test_warc_files_are_real(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    rows = [(i, f"http://h/{i}", f"<p>{i % 7}" + "z" * 150) for i in range(60)]
    path = warc.write_archives(pages(spark, rows), f"file://{tmp_path}")
    files = sorted(Path(path.removeprefix("file://")).glob("*.gz"))
    assert len(files) > 5
    kinds = Counter(h["warc-type"] for f in files for h, _, error in warc.records(gzip.decompress(f.read_bytes())) if error is None)
    assert kinds == {"request": 60, "metadata": 60, "response": 7, "revisit": 53}
    for f in files:
        for headers, _, error in warc.records(gzip.decompress(f.read_bytes())):
            assert error is None and ("warc-refers-to" in headers) == (headers["warc-type"] == "revisit")


def test_warc_query_equals_its_sql(spark, sf_dir, tmp_path):
    """Payloads are measured where they are read, and links go by record ids."""
    big = "b" * 120
    rows = [(1, "u", big), (2, "v", big), (3, None, None), (4, "w", "short"), (5, "w", "short"), (6, "ü\n", big), (7, "x", "é" * 50), (8, "x", "é" * 50), (9, "y", "é" * 49), (10, "y", "é" * 49)]
    pages(spark, rows).write.parquet(f"{tmp_path}/pages.parquet")
    pages_view = duckdb.connect()
    pages_view.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = pages_view.execute(queries.ORACLES["op7_warc"]).fetchall()
    assert sorted(map(tuple, queries.op7_warc(spark, str(tmp_path)).collect()), key=str) == sorted(want, key=str)


def parsed(archive):
    return [(h.get("warc-type"), error) for h, _, error in warc.records(archive)]


def test_warc_damage_is_reported_and_passed_over(spark):
    one, two = (warc.capture(i, "u", b"x" * 50, hashlib.sha256(b"x" * 50).hexdigest(), None, None, False) for i in (1, 2))
    good = ["request", "response", "metadata"]
    assert [k for k, _ in parsed(one + two)] == good * 2
    cut = parsed(one[:-3])
    assert [k for k, _ in cut] == ["request", "response", None] and "cut short" in cut[2][1]
    assert parsed(b"HELLO\r\n\r\n" + one)[0] == (None, "byte 0: no version line") and [k for k, _ in parsed(b"HELLO\r\n\r\n" + one)][1:] == good
    lied = re.sub(rb"Content-Length: \d{3}", b"Content-Length: 999", one, count=1)  # the response's
    assert [k for k, _ in parsed(lied + two)] == ["request", None, "metadata", *good]
    changed = one.replace(b"x" * 50, b"x" * 49 + b"y")
    packed = gzip.compress(one) + gzip.compress(two)
    broken = bytearray(packed)
    broken[-4] ^= 1
    wrong = {
        lied + two: "block is cut short or its length differs",
        changed: "payload differs from its digest",
        packed[:-20]: "gzip stream is cut short",
        bytes(broken): "incorrect length check",
        b"\x1f\x8bnothing": "unknown compression method",
        packed: None,
        b"": None,
    }
    for archive, error in wrong.items():
        rows = warc.read_records(spark.createDataFrame([(bytearray(archive),)], "warc binary"))
        found = [r["error"] for r in rows.filter("error is not null").collect()]
        assert any(error in e for e in found) if error else not found, (error, found)
        whole = warc.assemble(rows).filter("capture.response is not null and capture.metadata is not null").count()
        assert whole >= {lied + two: 1, packed: 2, packed[:-20]: 1, bytes(broken): 2}.get(archive, 0)


# --- BPE ---------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=200))
def test_bpe_equals_tiktoken(reference, text):
    codec = bpe.codec(PATH, PATTERN)
    ids = codec.encode(text)
    assert ids == b"".join(i.to_bytes(4, "little") for i in reference.encode_ordinary(text))
    assert codec.decode(ids) == text.encode()


def test_bpe_ranks_must_be_whole(tmp_path):
    for lines in (b"YQ== 0\nYg== 0\nYw== 1\n", b"YQ== 0\nYg== 2\n"):
        (tmp_path / "ranks").write_bytes(lines)
        with pytest.raises(ValueError):
            bpe.read_ranks(str(tmp_path / "ranks"))


def test_bpe_table(spark, reference):
    out = bpe.decode(bpe.encode(table(spark, ODD_ROWS), PATH, PATTERN), PATH, PATTERN).collect()
    assert len(out) == len(ODD_ROWS)
    for i, text, *_ in ODD_ROWS:
        if i is not None:
            row = next(r for r in out if r["doc_id"] == i)
            ids = b"".join(x.to_bytes(4, "little") for x in reference.encode_ordinary(text or ""))
            assert (row["n_tokens"], row["ids_sha256"], bytes(row["decoded"])) == (len(ids) // 4, hashlib.sha256(ids).hexdigest(), (text or "").encode())
    assert bpe.encode(table(spark, []), PATH, PATTERN).count() == 0


def test_query_columns(spark, sf_dir):
    bpe_rows = by_id(queries.op10_bpe(spark, sf_dir).limit(5))
    texts = by_id(spark.read.parquet(f"{sf_dir}/documents.parquet").filter(F.col("doc_id").isin(list(bpe_rows))))
    assert all(bpe_rows[i]["decoded_sha256"] == sha(texts[i]["text"]) for i in bpe_rows)
