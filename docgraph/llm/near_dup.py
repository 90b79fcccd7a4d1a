"""MinHash near-duplicates: one permutation, optimal densification, star-shaped candidates.

1. Each text becomes the set of its word shingles' 64-bit hashes. One permutation
   hashes the set: a shingle's top bits choose its bin, a bin keeps its least
   shingle, and an empty bin takes the value of a bin that a universal hash of
   (bin, attempt) picks, the same for all documents. Bands of bins are hashed to
   buckets: with ``COARSE`` a pair at the threshold meets in none of them with
   probability (1 - 0.8 ** 4) ** 32 = 5e-8.
2. Documents with the same set form a class; only its smallest doc_id goes on.
3. Each bucket links its members to its smallest id only, a star. These
   candidates are confirmed on the full sets, and components result.
4. A star can miss a link between two members that its hub isn't similar to. So
   every bucket whose members are still in several components is searched
   exactly: members outside the hub's component ask all members, by posting
   lists of the full sets, in blocks of bounded rows and bytes, without writing
   pairs out; of the links found, only those that join components are emitted.
5. A bucket that would take over ``MOST_BLOCKS`` blocks, as boilerplate makes them,
   isn't searched as it is: its members are hashed anew into the ``FINE`` bands,
   whose longer keys part what is only somewhat similar (a pair at the threshold
   meets in none of them with probability (1 - 0.8 ** 8) ** 128 = 6e-11), and
   steps 3 and 4 run on those buckets, whatever their size.

Defined results: a document with fewer words than a shingle has one shingle of
them all; one without words has none and is linked with nothing. A row with a
null doc_id is linked with nothing, has a null component_id and stays. Rows of
one doc_id are one node, whatever their texts; each row has its own n_shingles.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docgraph.operators.components import components
from docgraph.sources import scratch

SHINGLE_WORDS = 5
#: Similarity as a percentage.
THRESHOLD = 80
#: Words whose hashes a task remembers.
MEMO = 150_000
#: Members that answer in a block of the exact search; twice as many ask in it.
BLOCK = 512
#: Shingles of a block, for either side: 16 MB of hashes.
BLOCK_SHINGLES = 2_000_000
#: Blocks of a bucket beyond which its members go into finer buckets first.
MOST_BLOCKS = 64
#: Rows of a bucket that one task joins with what is known of the bucket.
SALT_ROWS = 1000
ATTEMPTS = 64
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Banding:
    """One permutation in ``bands * rows`` bins (a power of two); ``seed`` makes another permutation."""

    def __init__(self, bands: int, rows: int, seed: int = 0) -> None:
        self.bands, self.rows, self.bins, self.seed = bands, rows, bands * rows, _U(seed)
        self.bounds = np.arange(self.bins, dtype=_U) << _U(65 - self.bins.bit_length())
        #: The bin that empty bin b copies at each attempt.
        donors = mix(np.arange(ATTEMPTS * self.bins, dtype=_U) + _U(0x9E3779B97F4A7C15)) >> _U(20)
        self.donors = donors.astype(np.int64).reshape(ATTEMPTS, self.bins) % self.bins
        self.salt = mix(np.arange(1, bands + 1, dtype=_U) * _U(0xD6E8FEB86659FD93) + self.seed)

    def signature(self, hashes: np.ndarray) -> np.ndarray:
        """The densified minima of all bins of a sorted, non-empty set."""
        if self.seed:
            hashes = np.sort(mix(hashes ^ self.seed))
        at = np.searchsorted(hashes, self.bounds)
        filled = at < np.append(at[1:], len(hashes))
        values = np.zeros(self.bins, _U)
        values[filled] = hashes[at[filled]]
        empty = np.flatnonzero(~filled)
        for attempt in range(ATTEMPTS):
            if not len(empty):
                break
            donors = self.donors[attempt, empty]
            good = filled[donors]
            values[empty[good]] = values[donors[good]]
            empty = empty[~good]
        if len(empty):  # all attempts failed: the next filled bin
            order = np.flatnonzero(filled)
            values[empty] = values[order[np.searchsorted(order, empty) % len(order)]]
        return values

    def keys(self, hashes: np.ndarray) -> np.ndarray:
        """A bucket key for each band."""
        keys = self.salt.copy()
        for column in self.signature(hashes).reshape(self.bands, self.rows).T:
            keys = mix(keys ^ column) + self.salt
        return keys


COARSE = Banding(32, 4)
FINE = Banding(128, 8, seed=0x5851F42D4C957F2D)


class Shingler:
    """Sets of shingle hashes; remembers words' hashes, within a bound."""

    def __init__(self, words: int) -> None:
        self.words = words
        self.memo: dict[bytes, int] = {}
        self.factors = [_U(int(f)) for f in mix(np.arange(1, words + 1, dtype=_U)) | _U(1)]

    def hashes(self, text: bytes) -> np.ndarray:
        """Sorted distinct shingle hashes of UTF-8 text."""
        words = text.lower().split()
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        out = list(map(memo.get, words))
        if None in out:
            for i, own in enumerate(out):
                if own is None:
                    out[i] = own = xxhash.xxh3_64_intdigest(words[i])
                    if len(memo) <= MEMO:
                        memo[words[i]] = own
        h = np.array(out, _U)
        if not len(h):
            return h
        size = min(self.words, len(h))
        total = np.zeros(len(h) - size + 1, _U)
        for i in range(size):
            total += h[i : len(h) - size + 1 + i] * self.factors[i]
        return np.unique(mix(total + _U(size)))


_SKETCH_DDL = "doc_id long, n_shingles long, f1 long, f2 long, bands array<long>"
_SKETCH = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()), ("bands", pa.list_(pa.int64()))])


def _sketch(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            sizes, f1, f2, bands, ends = [], [], [], [], [0]
            for body in batch.column(1).to_pylist():
                hashes = shingler.hashes(body)
                sizes.append(len(hashes))
                digest = np.frombuffer(xxhash.xxh3_128_digest(hashes.tobytes()), np.int64)
                f1.append(int(digest[0]))
                f2.append(int(digest[1]))
                if len(hashes):
                    bands.append(COARSE.keys(hashes))
                ends.append(ends[-1] + (COARSE.bands if len(hashes) else 0))
            flat = np.concatenate(bands).view(np.int64) if bands else np.empty(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
            yield pa.record_batch([batch.column(0), pa.array(sizes, pa.int64()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()), lists], schema=_SKETCH)

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            sets = [shingler.hashes(body).view(np.int64) for body in batch.column(1).to_pylist()]
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            flat = np.concatenate(sets) if sets else np.empty(0, np.int64)
            yield pa.record_batch([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["id", "hashes"])

    return run


def similar(inter, size_a, size_b, threshold: int):
    return 100 * inter >= threshold * (size_a + size_b - inter)


def _finer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, size and the fine buckets of sets."""
    for batch in batches:
        ids, keys, sizes = [], [], []
        for doc_id, hashes in zip(batch.column(0).to_pylist(), _arrays(batch.column(1)), strict=True):
            own = FINE.keys(hashes.view(_U)).view(np.int64)
            keys.append(own)
            ids.append(np.full(len(own), doc_id))
            sizes.append(np.full(len(own), len(hashes)))
        if ids:
            yield pa.record_batch([pa.array(np.concatenate(x)) for x in (keys, ids, sizes)], ["key", "id", "size"])


def _arrays(lists: pa.ListArray) -> list[np.ndarray]:
    ends = lists.offsets.to_numpy()
    return np.split(lists.values.to_numpy()[ends[0] : ends[-1]], ends[1:-1] - ends[0]) if len(lists) else []


def _search(threshold: int):
    """Exact search in one block of a bucket: who asks against who answers; links that join components."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids, comps, asks = (table.column(n).to_numpy() for n in ("id", "comp", "asks"))
        sets = [x for chunk in table.column("hashes").chunks for x in _arrays(chunk)]
        there = np.flatnonzero(~asks)
        sizes = np.array([len(sets[i]) for i in there], np.int64)
        flat = np.concatenate([sets[i] for i in there]) if len(there) else np.empty(0, np.int64)
        order = np.argsort(flat, kind="stable")
        keys, postings = flat[order], np.repeat(np.arange(len(there)), sizes)[order]
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                x = parent[x]
            return x

        out = []
        for q in np.flatnonzero(asks):
            own = sets[q]
            low, high = np.searchsorted(keys, own, "left"), np.searchsorted(keys, own, "right")
            shared = np.zeros(len(there), np.int64)
            for begin in range(0, len(own), 4096):
                a, n = low[begin : begin + 4096], (high - low)[begin : begin + 4096]
                places = np.repeat(a - np.cumsum(n) + n, n) + np.arange(n.sum())
                shared += np.bincount(postings[places], minlength=len(there))
            for m in np.flatnonzero(similar(shared, len(own), sizes, threshold) & (comps[there] != comps[q])):
                a, b = root(int(comps[q])), root(int(comps[there[m]]))
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    out.append((int(ids[q]), int(ids[there[m]])))
        return pa.table({"a": pa.array([x[0] for x in out], pa.int64()), "b": pa.array([x[1] for x in out], pa.int64())})

    return run


def sketches(docs: DataFrame, words: int, folder: str) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.encode(F.coalesce("text", F.lit("")), "utf-8").alias("body"))
    return scratch.materialise(rows.mapInArrow(_sketch(words), _SKETCH_DDL), folder, "sketches")


def _members(rows: DataFrame, folder: str, name: str) -> DataFrame:
    """key, id, size, hub, n of the rows (key, id, size) that share their bucket with another id."""
    buckets = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("hub"), F.max("id").alias("last")).filter("hub <> last").drop("last")
    return scratch.materialise(rows.join(buckets, "key").select("key", "id", "size", "hub", "n"), folder, name)


def _stars(members: DataFrame, sets: DataFrame, threshold: int, folder: str, name: str) -> DataFrame:
    """a, b: hubs and the members of their buckets that are similar to them."""
    stars = members.filter("id <> hub").select("id", "hub").distinct()
    inter = F.size(F.array_intersect("hashes", "hub_hashes"))
    # A table of its own without buckets, so that the join on hubs shuffles both sides and Spark can split a hub's many members.
    hub_sets = sets.join(stars.select(F.col("hub").alias("id")).distinct(), "id", "left_semi").select(F.col("id").alias("hub"), F.col("hashes").alias("hub_hashes"))
    pairs = stars.join(sets, "id").join(scratch.materialise(hub_sets, folder, f"{name}_hubs"), "hub")
    small, large = F.least(F.size("hashes"), F.size("hub_hashes")), F.greatest(F.size("hashes"), F.size("hub_hashes"))
    confirmed = pairs.filter(100 * small >= threshold * large).filter(similar(inter, F.size("hashes"), F.size("hub_hashes"), threshold))
    return scratch.materialise(confirmed.select(F.col("hub").alias("a"), F.col("id").alias("b")), folder, name)


def _joined(labels: DataFrame, links: DataFrame, folder: str, name: str) -> DataFrame:
    """``labels`` after further links: components of the components that they join."""
    one, two = labels.select(F.col("node").alias("a"), F.col("label").alias("x")), labels.select(F.col("node").alias("b"), F.col("label").alias("y"))
    between = links.join(one, "a", "left").join(two, "b", "left").select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b")).distinct()
    moved = components(scratch.materialise(between, folder, f"{name}_between"), folder, name)
    known = labels.union(links.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(labels.select("node"), "node", "left_anti").select("node", "node"))
    return known.join(moved.select(F.col("node").alias("label"), F.col("label").alias("least")), "label", "left").select("node", F.coalesce("least", "label").alias("label"))


def _unresolved(members: DataFrame, labels: DataFrame, block: int) -> DataFrame:
    """key, id, comp, asks, blocks, turns of the members of buckets that are in several components.

    What is known of a bucket is folded by component first, and joined with its
    members in slices, so that no task gathers a large bucket.
    """
    placed = members.join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn("comp", F.coalesce("label", "id"))
    sign = F.xxhash64("id")
    by_comp = placed.groupBy("key", "comp").agg(
        F.count("*").alias("rows"), F.sum("size").alias("weight"), F.max(F.col("id") == F.col("hub")).alias("own"), F.max("n").alias("n"), F.bit_xor(sign).alias("x"), F.sum(sign.bitwiseAND((1 << 40) - 1)).alias("s")
    )

    def outside(c: str):
        return F.sum(F.when(~F.col("own"), F.col(c)).otherwise(0))

    known = by_comp.groupBy("key").agg(
        F.count("*").alias("comps"), F.max("n").alias("n"), F.bit_xor("x").alias("x"), F.sum("s").alias("s"), F.max(F.when(F.col("own"), F.col("comp"))).alias("hub_comp"),
        F.sum("weight").alias("weight"), outside("rows").alias("askers"), outside("weight").alias("asked"),
    )
    # A pair is its own star. Buckets with the same members need one search.
    known = known.filter("n > 2 and comps > 1").groupBy("n", "x", "s").agg(F.min_by(F.struct("key", "hub_comp", "weight", "askers", "asked"), "key").alias("one")).select("n", "one.*")

    def parts(rows: str, most: int, shingles: str):
        return F.greatest(F.ceil(F.col(rows) / most), F.ceil(F.col(shingles) / BLOCK_SHINGLES)).cast("int")

    slices = F.ceil(F.col("n") / SALT_ROWS).cast("int")
    wanted = known.select("key", "hub_comp", parts("n", block, "weight").alias("blocks"), parts("askers", 2 * block, "asked").alias("turns"), F.explode(F.sequence(F.lit(0), slices - 1)).alias("slice"))
    sliced = placed.withColumn("slice", F.pmod(F.xxhash64(F.lit(2), "id"), slices).cast("int"))
    return sliced.join(wanted, ["key", "slice"]).select("key", "id", "comp", (F.col("comp") != F.col("hub_comp")).alias("asks"), "blocks", "turns")


def _searched(todo: DataFrame, sets: DataFrame, threshold: int, folder: str, name: str) -> DataFrame:
    """a, b: links between components that the members of unresolved buckets have."""
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    turn = F.pmod(F.xxhash64(F.lit(1), "id"), F.col("turns")).cast("int")

    def visits(n: str, make):
        return F.transform(F.sequence(F.lit(0), F.col(n) - 1), make)

    answers = visits("turns", lambda i: F.struct(i.alias("i"), block.alias("j"), F.lit(False).alias("asks")))
    questions = F.when(F.col("asks"), visits("blocks", lambda j: F.struct(turn.alias("i"), j.alias("j"), F.lit(True).alias("asks")))).otherwise(F.array())
    cells = todo.select("key", "id", "comp", F.explode(F.concat(answers, questions)).alias("at")).select("key", "at.i", "at.j", "id", "comp", "at.asks")
    found = cells.join(sets, "id").groupBy("key", "i", "j").applyInArrow(_search(threshold), "a long, b long")
    return scratch.materialise(found, folder, name)


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, threshold: int = THRESHOLD, block: int = BLOCK, most_blocks: int = MOST_BLOCKS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of ``docs``."""
    spark = docs.sparkSession
    folder = scratch.new_folder(spark, "near_dup")
    sk = sketches(docs, words, folder)
    usable = sk.filter("n_shingles > 0 and doc_id is not null")
    classes = scratch.materialise(usable.groupBy("f1", "f2").agg(F.min("doc_id").alias("rep")), folder, "classes")
    # Rows of one doc_id with several sets tie the sets' classes together.
    several = usable.groupBy("doc_id").agg(F.min(F.struct("f1", "f2")).alias("low"), F.max(F.struct("f1", "f2")).alias("high")).filter("low <> high").select("doc_id")
    ties = usable.join(several, "doc_id").join(classes, ["f1", "f2"]).filter("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))

    rows = usable.join(classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi").select(F.explode("bands").alias("key"), F.col("doc_id").alias("id"), F.col("n_shingles").alias("size")).distinct()
    members = _members(rows, folder, "members")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.encode(F.coalesce("text", F.lit("")), "utf-8").alias("body"))
    wanted = texts.join(members.select("id").distinct(), "id", "left_semi")
    sets = scratch.bucketed(wanted.mapInArrow(_sets(words), "id long, hashes array<long>"), folder, "sets", scratch.shuffle_partitions(spark), "id")

    links = _stars(members, sets, threshold, folder, "links")
    labels = components(links.union(scratch.materialise(ties, folder, "ties")), folder, "stars")
    todo = scratch.materialise(_unresolved(members, labels, block), folder, "unresolved")
    bounded = F.col("blocks") * F.col("turns") <= most_blocks
    more = _searched(todo.filter(bounded), sets, threshold, folder, "more_links")
    if more.limit(1).count():
        labels = scratch.materialise(_joined(labels, more, folder, "more"), folder, "labels_more")
    large = todo.filter(~bounded).select("id").distinct()
    if large.limit(1).count():
        finer = _members(sets.join(large, "id", "left_semi").mapInArrow(_finer, "key long, id long, size long").distinct(), folder, "finer")
        labels = scratch.materialise(_joined(labels, _stars(finer, sets, threshold, folder, "finer_links"), folder, "finer_stars"), folder, "labels_finer")
        rest = scratch.materialise(_unresolved(finer, labels, block), folder, "finer_unresolved")
        labels = scratch.materialise(_joined(labels, _searched(rest, sets, threshold, folder, "last_links"), folder, "last"), folder, "labels_last")

    placed = classes.join(labels, F.col("rep") == F.col("node"), "left").select("f1", "f2", F.coalesce("label", "rep").alias("component"))
    linked = sk.withColumns({f: F.when(F.col("n_shingles") > 0, F.col(f)) for f in ("f1", "f2")}).join(placed, ["f1", "f2"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return linked.select("doc_id", "n_shingles", component.alias("component_id"), (F.col("doc_id").isNull() | (F.col("doc_id") == component)).alias("kept"))
