"""Best-fit packing of documents into training sequences under conflicts.

A sequence (bin) holds ``capacity`` words at most, and never two documents of one
source or of one cluster of duplicates. Documents longer than a bin are cut: whole
pieces fill a bin each, and the rest is packed. Items go by falling length. Open
bins are ordered by residual; each carries a bitmap of its sources and one of its
clusters. The search starts at the tightest bin that has room and goes on to the
next successor until one is compatible; else a new bin opens.

Rows are dealt into shards of about ``shard_rows`` by a hash of id and text; each
shard packs its own bins, so memory and search are bounded at every scale and a
hot source is spread over all shards.

Defined results: a null or text without words has length 1. A null source
conflicts with nothing, nor does the cluster of an empty text. Ties go to the
smaller doc_id (null first), then to the older bin. Rows that repeat are packed
again. Without ``cluster``, texts equal but for case form a cluster. Other columns
are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 2048
SHARD_ROWS = 2000
WORD = r"[^\x20\x09-\x0D]+"
_PACKED = [("doc_id", pa.int64()), ("piece", pa.int32()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("bin_id", pa.int64()), ("bin_offset", pa.int64())]
_PACKED_DDL = "doc_id long, piece int, first_word long, n_words long, bin_id long, bin_offset long"


class Bins:
    """Open bins by residual; ``sources`` and ``clusters`` are bitmaps by bin."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.sources: list[int] = []
        self.clusters: list[int] = []
        self.residuals: list[int] = []
        self.by_residual: dict[int, list[int]] = {}

    def _open(self, bin_: int, residual: int) -> None:
        if residual not in self.by_residual:
            insort(self.residuals, residual)
            self.by_residual[residual] = [bin_]
        else:
            insort(self.by_residual[residual], bin_)

    def place(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """The bin and offset for an item whose bits are ``source`` and ``cluster``."""
        for i in range(bisect_left(self.residuals, size), len(self.residuals)):
            residual = self.residuals[i]
            bins = self.by_residual[residual]
            for k, bin_ in enumerate(bins):
                if not (self.sources[bin_] & source or self.clusters[bin_] & cluster):
                    del bins[k]
                    if not bins:
                        del self.by_residual[residual], self.residuals[i]
                    self.sources[bin_] |= source
                    self.clusters[bin_] |= cluster
                    if residual > size:
                        self._open(bin_, residual - size)
                    return bin_, self.capacity - residual
        bin_ = len(self.sources)
        self.sources.append(source)
        self.clusters.append(cluster)
        if size < self.capacity:
            self._open(bin_, self.capacity - size)
        return bin_, 0


def pack_rows(rows: list[tuple], capacity: int, first_bin: int = 0) -> list[tuple]:
    """Pack (doc_id, length, source, cluster) rows; the columns of ``_PACKED``."""
    sources: dict[str, int] = {}
    repeated = [c for c, n in Counter(r[3] for r in rows).items() if n > 1 and c is not None]
    clusters = {c: 1 << i for i, c in enumerate(sorted(repeated))}
    items = []
    for doc_id, length, source, cluster in rows:
        bit = 0 if source is None else 1 << sources.setdefault(source, len(sources))
        whole, rest = divmod(length, capacity)
        pieces = [capacity] * whole + ([rest] if rest else [])
        items += [(-n, doc_id is not None, doc_id or 0, p, bit, clusters.get(cluster, 0)) for p, n in enumerate(pieces)]
    items.sort()
    bins = Bins(capacity)
    out = []
    for minus, has_id, doc_id, piece, source, cluster in items:
        bin_, offset = bins.place(-minus, source, cluster)
        out.append((doc_id if has_id else None, piece, piece * capacity, -minus, first_bin + bin_, offset))
    return out


def pack(docs: DataFrame, capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS, cluster: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, first_word, n_words, bin_id, bin_offset."""
    text = F.coalesce("text", F.lit(""))
    group = F.col(cluster) if cluster else F.when(F.length(text) > 0, F.xxhash64(F.lower(text)))
    shards = max(1, -(-docs.count() // shard_rows))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.greatest(F.regexp_count(text, F.lit(WORD)), F.lit(1)).cast("long").alias("length"),
        F.col("source").cast("string").alias("source"),
        group.alias("cluster"),
        F.pmod(F.xxhash64(F.col("doc_id"), text), F.lit(shards)).cast("int").alias("shard"),
    )

    def run(table: pa.Table) -> pa.Table:
        columns = [table.column(n).to_pylist() for n in ("doc_id", "length", "source", "cluster")]
        packed = pack_rows(list(zip(*columns, strict=True)), capacity, table.column("shard")[0].as_py() << 32)
        return pa.table([pa.array([r[i] for r in packed], kind) for i, (_, kind) in enumerate(_PACKED)], [n for n, _ in _PACKED])

    return rows.groupBy("shard").applyInArrow(run, _PACKED_DDL)
