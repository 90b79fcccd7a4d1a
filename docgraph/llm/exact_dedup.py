"""Exact de-duplication by an extendible-hash index on shared files.

1. Map tasks fold their own copies: one row for each distinct text of a task, so
   a group of copies that holds a third of the corpus reaches its owner as one
   row a task.
2. The 64-bit key space is cut into equal ranges, one owner task each. An owner
   inserts its rows into an extendible hash: a directory of 2**depth slots points
   at buckets; a bucket over ``capacity`` splits by its next bit, and the
   directory doubles when the bucket already used all of its bits. Equal keys
   chain, and a chain is searched by comparing bytes.
3. The buckets and the directory are written to the shared folder. Each document
   then looks its key up in the directory of the key's owner, and its text, by
   length and SHA-256, in the chain of its key in the bucket found. Both lookups are
   joins with tables, whose skewed side Spark splits. ``find`` does the same for
   texts that aren't in the index.

Defined results: a null text counts as empty. The survivor of a group is its
largest non-null doc_id; rows with a null doc_id count in ``group_size`` but are
kept only if their whole group has none. Rows that repeat a doc_id and text share
one verdict. Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgraph.sources import scratch

# The directory is stored by bucket: of 2**(global depth) slots, those that agree with a bucket's prefix in its own depth point at it.

#: Bytes of distinct text that a map task folds before it hands them on.
FOLD_BYTES = 32 << 20
#: Bytes of text that an owner is meant to hold.
OWNER_BYTES = 32 << 20
BUCKET_CAPACITY = 512
MAX_DEPTH = 60

_FOLDED = pa.schema([("h", pa.int64()), ("body", pa.binary()), ("keep_id", pa.int64()), ("group_size", pa.int64())])
_ENTRY = pa.schema(
    [
        ("bucket", pa.int64()),
        ("depth", pa.int32()),
        ("h", pa.int64()),
        ("chain", pa.int32()),
        ("text_sha256", pa.string()),
        ("n_bytes", pa.int64()),
        ("keep_id", pa.int64()),
        ("group_size", pa.int64()),
    ]
)
_ENTRY_DDL = "bucket long, depth int, h long, chain int, text_sha256 string, n_bytes long, keep_id long, group_size long"


def larger(a: int | None, b: int | None) -> int | None:
    if a is None or b is None:
        return b if a is None else a
    return max(a, b)


class Bucket:
    __slots__ = ("chains", "depth", "prefix", "size")

    def __init__(self, depth: int, prefix: int) -> None:
        self.depth, self.prefix, self.size = depth, prefix, 0
        self.chains: dict[int, list[list]] = {}


class ExtendibleHash:
    """Directory, buckets and chains of one owner; keys are unsigned 64-bit."""

    def __init__(self, capacity: int = BUCKET_CAPACITY) -> None:
        self.capacity, self.depth = capacity, 0
        self.directory = [Bucket(0, 0)]

    def insert(self, key: int, body: bytes, doc_id: int | None, count: int) -> None:
        bucket = self.directory[key & ((1 << self.depth) - 1)]
        chain = bucket.chains.setdefault(key, [])
        for entry in chain:
            if entry[0] == body:
                entry[1] = larger(entry[1], doc_id)
                entry[2] += count
                return
        chain.append([body, doc_id, count])
        bucket.size += 1
        while bucket.size > self.capacity and len(bucket.chains) > 1 and bucket.depth < MAX_DEPTH:
            bucket = self._split(bucket)

    def _split(self, bucket: Bucket) -> Bucket:
        """Divide ``bucket`` by its next bit; the fuller half is returned."""
        if bucket.depth == self.depth:
            self.directory += self.directory
            self.depth += 1
        bit = 1 << bucket.depth
        low, high = Bucket(bucket.depth + 1, bucket.prefix), Bucket(bucket.depth + 1, bucket.prefix | bit)
        for key, chain in bucket.chains.items():
            half = high if key & bit else low
            half.chains[key] = chain
            half.size += len(chain)
        for half in (low, high):
            for slot in range(half.prefix, len(self.directory), 1 << half.depth):
                self.directory[slot] = half
        return max(low, high, key=lambda b: b.size)

    def buckets(self) -> list[Bucket]:
        return list({id(b): b for b in self.directory}.values())


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    groups: dict[bytes, list] = {}
    held = 0

    def rows() -> pa.RecordBatch:
        texts = list(groups)
        columns = zip(*groups.values(), strict=True) if groups else ([], [], [])
        h, keep, n = (list(c) for c in columns)
        return pa.record_batch([pa.array(h, pa.int64()), pa.array(texts, pa.binary()), pa.array(keep, pa.int64()), pa.array(n, pa.int64())], schema=_FOLDED)

    for batch in batches:
        for h, body, doc_id in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            group = groups.get(body)
            if group is None:
                groups[body] = [h, doc_id, 1]
                held += len(body)
                if held > FOLD_BYTES:
                    yield rows()
                    groups, held = {}, 0
            else:
                group[1] = larger(group[1], doc_id)
                group[2] += 1
    if groups:
        yield rows()


def _own(capacity: int, key_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = ExtendibleHash(capacity)
        mask = (1 << key_bits) - 1
        for batch in batches:
            for h, body, keep, n in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                index.insert(h & mask, body, keep, n)
        for bucket in index.buckets():
            rows = [
                {
                    "bucket": bucket.prefix,
                    "depth": bucket.depth,
                    "h": key - (1 << 64) if key >> 63 else key,
                    "chain": position,
                    "text_sha256": hashlib.sha256(body).hexdigest(),
                    "n_bytes": len(body),
                    "keep_id": keep,
                    "group_size": n,
                }
                for key, chain in bucket.chains.items()
                for position, (body, keep, n) in enumerate(chain)
            ]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_ENTRY)

    return run


def key_column(text, key_bits: int):
    """``key_bits`` under 64 make collisions, for tests."""
    h = F.xxhash64(text)
    return h if key_bits == 64 else h.bitwiseAND(F.lit((1 << key_bits) - 1))


class Index:
    """The stored tables: ``directory`` (owner, depth, bucket) and ``entries`` (owner, bucket, h, chain, ...)."""

    def __init__(self, directory: DataFrame, entries: DataFrame, owner_bits: int, key_bits: int) -> None:
        self.directory, self.entries, self.owner_bits, self.key_bits = directory, entries, owner_bits, key_bits

    def owner(self) -> Column:
        return _owner(self.owner_bits, self.key_bits)

    def find(self, docs: DataFrame) -> DataFrame:
        """doc_id, text_sha256, keep_id and group_size of the documents of ``docs`` (doc_id, text) whose text the index has."""
        text = F.coalesce("text", F.lit(""))
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), key_column(text, self.key_bits).alias("h"), F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(F.encode(text, "utf-8"), 256).alias("text_sha256"))
        depths = [r[0] for r in self.directory.select("depth").distinct().collect()]  # MAX_DEPTH + 1 at most
        guess = F.explode(F.array(*(F.struct(F.lit(d).alias("depth"), F.col("h").bitwiseAND(F.lit((1 << d) - 1)).alias("bucket")) for d in depths)) if depths else F.array().cast("array<struct<depth:int,bucket:long>>"))
        guessed = rows.withColumn("owner", self.owner()).select("*", guess.alias("at")).select(*rows.columns, "owner", "at.depth", "at.bucket")
        placed = guessed.join(self.directory, ["owner", "depth", "bucket"]).drop("depth")
        entries = self.entries.select("owner", "bucket", "h", "n_bytes", "text_sha256", "keep_id", "group_size")
        return placed.join(entries, ["owner", "bucket", "h", "n_bytes", "text_sha256"]).select("doc_id", "text_sha256", "keep_id", "group_size")


def _owner(owner_bits: int, key_bits: int) -> Column:
    return F.shiftrightunsigned("h", max(0, key_bits - owner_bits)).cast("int")


def build_index(docs: DataFrame, folder: str, capacity: int = BUCKET_CAPACITY, key_bits: int = 64) -> Index:
    """Write the index of all texts of ``docs`` (doc_id, text) below ``folder``."""
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    total = docs.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    bits = max(total // OWNER_BYTES, scratch.shuffle_partitions(spark) - 1, 1).bit_length()
    owner = _owner(bits, key_bits)
    folded = docs.select(key_column(text, key_bits).alias("h"), F.encode(text, "utf-8").alias("body"), F.col("doc_id").cast("long")).mapInArrow(_fold, "h long, body binary, keep_id long, group_size long")
    entries = folded.repartitionById(1 << bits, owner).mapInArrow(_own(capacity, key_bits), _ENTRY_DDL).withColumn("owner", owner)
    entries = scratch.materialise(entries, folder, "buckets")
    directory = scratch.materialise(entries.select("owner", "depth", "bucket").distinct(), folder, "directory")
    return Index(directory, entries, bits, key_bits)


def exact_dedup(docs: DataFrame, capacity: int = BUCKET_CAPACITY, key_bits: int = 64) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    index = build_index(docs, scratch.new_folder(docs.sparkSession, "exact_dedup"), capacity, key_bits)
    return index.find(docs).select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
