"""Media columns in Ogg: documents as 8-bit samples in a physical Ogg stream.

``store`` writes each text as two multiplexed logical streams whose pages alternate, one
of 8-bit mono samples and one of metadata about them (the length of the text, then
the time reached by each page of samples). ``read`` walks the pages of such bytes, verifies
every page's checksum, reassembles packets from the lacing values (also across
pages), demultiplexes the logical streams by serial number and derives times from
granule positions.

Defined results: a null text counts as empty, an empty text becomes 192 blanks.
Stored bytes depend on the text alone, so equal texts give equal values. Bytes
that are not valid Ogg give a row whose ``error`` says why and whose other values
are null. Rows repeat as in the input; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNIT = 192
RATE = 8000
PACKET = 10 * UNIT
SAMPLES, META = 0x53414D50, 0x4D455441
CONTINUED, FIRST, LAST = 1, 2, 4
_HEAD = struct.Struct("<4sBBqIIIB")
_REVERSED = bytes(int(f"{i:08b}"[::-1], 2) for i in range(256))
_NO_GRANULE = -1


def page_checksum(page: bytes) -> int:
    """The page's CRC with its own field taken as zero.

    Ogg's CRC shifts left, starts at 0 and is not inverted; zlib's has the same
    polynomial, mirrored. So mirrored bytes go through zlib, and its inversions
    are undone.
    """
    mirrored = page.translate(_REVERSED)
    crc = zlib.crc32(mirrored[26:], zlib.crc32(b"\0\0\0\0", zlib.crc32(mirrored[:22], 0xFFFFFFFF))) ^ 0xFFFFFFFF
    return int.from_bytes(crc.to_bytes(4, "little").translate(_REVERSED), "big")


def _page(flags: int, granule: int, serial: int, number: int, lacing: bytes, body: bytes) -> bytes:
    page = bytearray(_HEAD.pack(b"OggS", 0, flags, granule, serial, number, 0, len(lacing)) + lacing + body)
    page[22:26] = page_checksum(bytes(page)).to_bytes(4, "little")
    return bytes(page)


def _laced(size: int) -> bytes:
    return b"\xff" * (size // 255) + bytes([size % 255])


def _single(flags: int, granule: int, serial: int, number: int, packet: bytes) -> bytes:
    return _page(flags, granule, serial, number, _laced(len(packet)), packet)


def encode(payload: bytes, n_bytes: int) -> bytes:
    """The physical stream of ``payload``; ``n_bytes`` of it are text."""
    pages = [
        _single(FIRST, 0, SAMPLES, 0, b"\x7fPCM8\x01" + struct.pack("<II", RATE, 1)),
        _single(FIRST, 0, META, 0, b"\x7fMETA\x01"),
        _single(0, 0, META, 1, b"n_bytes=%d" % n_bytes),
    ]
    full, rest = divmod(len(payload), PACKET)
    lacing = _laced(PACKET) * full + (_laced(rest) if rest else b"")
    at, number, continued = 0, 1, 0
    for begin in range(0, len(lacing), 255):
        own = lacing[begin : begin + 255]
        end = at + sum(own)
        open_end = own[-1] == 255
        done = end // PACKET * PACKET if open_end else end
        granule = done if done > at // PACKET * PACKET or not open_end else _NO_GRANULE
        last = LAST if begin + 255 >= len(lacing) else 0
        pages.append(_page(continued | last, granule, SAMPLES, number, own, payload[at:end]))
        pages.append(_single(last, done, META, number + 1, b"ms=%d" % (done * 1000 // RATE)))
        at, number, continued = end, number + 1, CONTINUED if open_end else 0
    return b"".join(pages)


class Stream:
    """A logical stream: its packets, and (granule, packets so far) of each page that ends one."""

    def __init__(self) -> None:
        self.packets: list[bytes] = []
        self.marks: list[tuple[int, int]] = []
        self.open: list[bytes] = []
        self.pages, self.ended = 0, False


def demultiplex(media: bytes) -> dict[int, Stream]:
    """The logical streams of ``media`` by serial number; ValueError if it is damaged."""
    streams: dict[int, Stream] = {}
    at = 0
    while at < len(media):
        if len(media) - at < 27:
            raise ValueError("truncated page header")
        magic, version, flags, granule, serial, number, crc, segments = _HEAD.unpack_from(media, at)
        if magic != b"OggS" or version:
            raise ValueError("capture pattern missing")
        begin = at + 27 + segments
        lacing = media[at + 27 : begin]
        end = begin + sum(lacing)
        page = media[at:end]
        if len(lacing) != segments or end > len(media):
            raise ValueError("truncated page")
        if page_checksum(page) != crc:
            raise ValueError("page checksum differs")
        if flags & FIRST and serial in streams or not flags & FIRST and serial not in streams:
            raise ValueError("stream begins out of order")
        stream = streams.setdefault(serial, Stream())
        if number != stream.pages:
            raise ValueError("page lost")
        if bool(flags & CONTINUED) != bool(stream.open):
            raise ValueError("packet continuation differs")
        stream.pages += 1
        before = len(stream.packets)
        packet = begin
        place = begin
        for value in lacing:
            place += value
            if value < 255:
                stream.packets.append(b"".join([*stream.open, media[packet:place]]))
                stream.open, packet = [], place
        if packet < place or lacing and lacing[-1] == 255:
            stream.open.append(media[packet:place])
        if len(stream.packets) > before:
            stream.marks.append((granule, len(stream.packets)))
        stream.ended |= bool(flags & LAST)
        at = end
    if any(s.open or not s.ended for s in streams.values()):
        raise ValueError("stream without end")
    return streams


def decode(media: bytes) -> tuple[bytes, int, dict[str, int | float]]:
    """Payload, text bytes and the features of a stream made by :func:`encode`."""
    streams = demultiplex(media)
    if set(streams) != {SAMPLES, META}:
        raise ValueError("unknown logical streams")
    samples, meta = streams[SAMPLES], streams[META]
    if not samples.packets or not samples.packets[0].startswith(b"\x7fPCM8\x01"):
        raise ValueError("no sample header")
    rate, _ = struct.unpack("<II", samples.packets[0][6:])
    payload = b"".join(samples.packets[1:])
    granule = samples.marks[-1][0]
    if granule != len(payload):
        raise ValueError("granule position differs from the samples")
    marked = [int(m.partition(b"=")[2]) for m in meta.packets[2:]]
    if marked[-1:] != [granule * 1000 // rate] or marked != sorted(marked):
        raise ValueError("metadata's times differ from the samples'")
    wave = np.frombuffer(payload, np.uint8).astype(np.int16) - 128
    features = {
        "streams": len(streams),
        "pages": sum(s.pages for s in streams.values()),
        "packets": sum(len(s.packets) for s in streams.values()),
        "rate": rate,
        "duration_ms": granule * 1000 // rate,
        "last_page_ms": (samples.marks[-2][0] if len(samples.marks) > 2 else 0) * 1000 // rate,
        "peak": int(np.abs(wave).max()),
        "rms": round(float(np.sqrt(np.mean(np.square(wave, dtype=np.float64)))), 3),
    }
    return payload, int(meta.packets[1].partition(b"=")[2]), features


def _store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        media = []
        for body in batch.column(1).to_pylist():
            size = len(body)
            media.append(encode(body.ljust(max(UNIT, -(-size // UNIT) * UNIT), b" "), size))
        yield pa.record_batch([batch.column(0), pa.array(media, pa.binary())], ["doc_id", "media"])


_READ_DDL = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, error string"
_READ = pa.schema([("doc_id", pa.int64()), *((k, pa.int64() if t == "long" else pa.string()) for k, t in (c.split() for c in _READ_DDL.split(", ")[1:]))])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, media in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            row = {"doc_id": doc_id}
            try:
                payload, n_bytes, features = decode(media or b"")
                row |= {
                    "n_bytes": n_bytes,
                    "payload_bytes": len(payload),
                    "payload_sha256": hashlib.sha256(payload).hexdigest(),
                    "tail_crc32": zlib.crc32(payload[-16:]),
                    "media_bytes": len(media),
                    "media_sha256": hashlib.sha256(media).hexdigest(),
                    "feature": ";".join(f"{k}={v}" for k, v in features.items()),
                }
            except (ValueError, IndexError, struct.error) as e:
                row["error"] = str(e)
            rows.append(row)
        yield pa.RecordBatch.from_pylist(rows, schema=_READ)


def store(docs: DataFrame) -> DataFrame:
    """doc_id, media: the Ogg bytes of each text."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.encode(F.coalesce("text", F.lit("")), "utf-8").alias("body")).mapInArrow(_store, "doc_id long, media binary")


def read(stored: DataFrame) -> DataFrame:
    """Digests and features of stored media (doc_id, media), one row each."""
    return stored.select("doc_id", "media").mapInArrow(_read, _READ_DDL)
