"""Line de-duplication over levelled sorted runs of line hashes. DataFrame functions only.

Texts are hashed once into a narrow table of (doc_id, line hash) rows by batch;
batches come in descending doc_id. The state is a set of runs, each a table of (line hash, documents so far, largest doc_id) bucketed and sorted by
hash, in levels: when a level has ``fanout`` runs, they are compacted into one run
of the next. A new batch is merge-anti-joined with the settled entries of the runs,
those whose line already occurs in enough documents (their owner, met first, has
the largest doc_id, and no later batch changes either); what is left becomes the
batch's own run. Buckets are the same throughout, so runs join without a shuffle.

After the last batch the runs are compacted once more; lines of settled entries
are dropped everywhere but in their owner.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at its ends and A-Z lower-cased;
only keys of ``min_length`` code points or more count. Keys are told apart by two
chained 64-bit hashes.

Defined results: a null or empty text is one empty line. A document is a doc_id:
rows that repeat one count once for each of their lines, all lose what others own,
and all keep what their doc_id owns. A row with a null doc_id is never counted nor
changed. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgraph.sources import scratch

MIN_LENGTH = 40
MIN_DOCUMENTS = 5
BATCHES = 4
FANOUT = 2
_BLANK = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_KEY = ["h1", "h2"]


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(_BLANK)), _UPPER, _UPPER.lower())


def key_hash(key: Column) -> Column:
    """128 bits as a struct: the second hash starts from another seed."""
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(7), key).alias("h2"))


def hashes_of(text: Column, min_length: int = MIN_LENGTH) -> Column:
    """The distinct hashes of a text's keys that are long enough."""
    keys = F.filter(F.transform(F.filter(lines_of(text), lambda x: F.length(x) >= min_length), line_key), lambda k: F.length(k) >= min_length)
    return F.array_distinct(F.transform(keys, key_hash))


class Runs:
    """The levelled runs; ``buckets`` must be the shuffle partitions that make a batch."""

    def __init__(self, folder: str, buckets: int, fanout: int = FANOUT) -> None:
        self.folder, self.buckets, self.fanout = folder, buckets, fanout
        self.levels: list[list[DataFrame]] = [[]]
        self.made = 0

    def _write(self, df: DataFrame) -> DataFrame:
        self.made += 1
        return scratch.bucketed(df, self.folder, f"run_{self.made}", self.buckets, *_KEY)

    @staticmethod
    def _merge(a: DataFrame, b: DataFrame) -> DataFrame:
        """One entry per hash of two runs; a full join of sorted buckets."""
        b = b.select(*_KEY, F.col("n_docs").alias("n_b"), F.col("max_id").alias("max_b"))
        n = F.coalesce("n_docs", F.lit(0)) + F.coalesce("n_b", F.lit(0))
        return a.join(b, _KEY, "full").select(*_KEY, n.alias("n_docs"), F.greatest("max_id", "max_b").alias("max_id"))

    def all(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def merged(self) -> DataFrame | None:
        out = None
        for run in self.all():
            out = run if out is None else self._merge(out, run)
        return out

    def add(self, batch: DataFrame, settled_at: int) -> None:
        state = self.merged()
        if state is not None:
            batch = batch.join(state.filter(F.col("n_docs") >= settled_at), _KEY, "left_anti")
        self.levels[0].append(self._write(batch))
        for level in range(len(self.levels)):
            if len(self.levels[level]) >= self.fanout:
                out = self.levels[level][0]
                for run in self.levels[level][1:]:
                    out = self._merge(out, run)
                self.levels[level] = []
                if level + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[level + 1].append(self._write(out))


def line_hashes(docs: DataFrame, folder: str, min_length: int, batches: int) -> DataFrame:
    """doc_id, h1, h2, batch of each long line, once a document; batch 0 has the largest doc_ids."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(F.col("doc_id").isNotNull())
    cuts = docs.approxQuantile("doc_id", [i / batches for i in range(1, batches)], 0.01) if batches > 1 else []
    batch = sum((F.when(F.col("doc_id") <= int(c), 1).otherwise(0) for c in sorted(set(cuts))), F.lit(0))
    exploded = docs.select("doc_id", batch.alias("batch"), F.explode(hashes_of(F.col("text"), min_length)).alias("key"))
    rows = exploded.select("doc_id", "key.h1", "key.h2", "batch")
    rows.write.partitionBy("batch").parquet(f"{folder}/lines")
    lines = docs.sparkSession.read.schema(rows.schema).parquet(f"{folder}/lines")
    # Only rows that share their doc_id with others can repeat a line of it; as a rule there are none.
    several = scratch.materialise(docs.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id"), folder, "several")
    return lines.join(several, "doc_id", "left_anti").unionByName(lines.join(several, "doc_id", "left_semi").distinct())


def repeated_lines(lines: DataFrame, folder: str, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """h1, h2, max_id of each line of ``lines`` that occurs in ``min_documents`` documents or more."""
    runs = Runs(folder, scratch.shuffle_partitions(lines.sparkSession))
    last = lines.agg(F.max("batch")).head()[0] or 0
    for batch in range(last + 1):
        own = lines.filter(F.col("batch") == batch).groupBy(*_KEY)
        runs.add(own.agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("max_id")), min_documents)
    return scratch.materialise(runs.merged().filter(F.col("n_docs") >= min_documents).select(*_KEY, "max_id"), folder, "repeated")


def dropped_lines(docs: DataFrame, min_length: int = MIN_LENGTH, min_documents: int = MIN_DOCUMENTS, batches: int = BATCHES) -> DataFrame:
    """doc_id and the hashes of the lines it loses, for documents that lose any."""
    folder = scratch.new_folder(docs.sparkSession, "line_dedup")
    lines = line_hashes(docs, folder, min_length, batches)
    hot = repeated_lines(lines, folder, min_documents)
    found = lines.select("doc_id", *_KEY).join(hot, _KEY).filter(F.col("doc_id") != F.col("max_id"))
    return found.groupBy("doc_id").agg(F.collect_set(F.struct(*_KEY)).alias("drop"))


def _kept(text: Column, drop: Column, min_length: int) -> Column:
    return F.filter(lines_of(text), lambda line: (F.length(line) < min_length) | ~F.array_contains(drop, key_hash(line_key(line))))


def without(text: Column, drop: Column, min_length: int = MIN_LENGTH) -> Column:
    """``text`` less the lines whose hashes are in ``drop``."""
    return F.array_join(_kept(text, drop, min_length), "\n")


def line_dedup(docs: DataFrame, min_length: int = MIN_LENGTH, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """doc_id, n_lines, n_dropped and ``kept_text`` for each row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.join(dropped_lines(docs, min_length, min_documents), "doc_id", "left")
    n_lines = (F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1).cast("long")
    kept = F.when(F.col("drop").isNotNull(), _kept(F.col("text"), F.col("drop"), min_length))
    rows = rows.withColumn("kept", kept).withColumn("n_lines", n_lines)
    return rows.select(
        "doc_id",
        "n_lines",
        F.when(F.col("drop").isNull(), F.lit(0)).otherwise(F.col("n_lines") - F.size("kept")).cast("long").alias("n_dropped"),
        F.when(F.col("drop").isNull(), F.col("text")).otherwise(F.array_join("kept", "\n")).alias("kept_text"),
    )
