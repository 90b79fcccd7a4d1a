"""Quality classification by an interpolated modified Kneser-Ney model of trusted text.

The model is over characters (UTF-16 units, so that an n-gram of four is exactly one
64-bit number; control characters, tab and newline too, count as blanks), of order four, with three discounts an order, continuation counts
below the highest order, and a uniform floor. It is fitted on the whole of the
trusted text.

Documents are written once in chunks of bounded rows and bytes, bucketed by chunk. A chunk
asks for its distinct n-grams only, so what is shuffled follows the number of
distinct n-grams a chunk, not the length of the text. Counts are sharded by n-gram;
joins of asked n-grams with counts, with context totals and with the next lower
order give probabilities, and these go back to their chunks, where each document's
perplexity is summed. Texts are never shuffled.

Thresholds: a fifth of the trusted documents is kept out of training. A document is
judged by its log perplexity drawn towards its language's median as if by ``PRIOR``
more characters, so that short texts aren't rejected by chance. The quantile of the
held-out documents' scores, drawn likewise, is their language's threshold. Languages
with few of them use the median and the quantile over all.

Defined results: a null text counts as empty; an empty text is judged by its end
alone. Without trusted text every document is accepted. A null doc_id is never
trusted. A null lang forms a language of its own. Rows repeat as in the input;
other columns are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgraph.sources import scratch
from docgraph.llm.language_id import held_out

ORDER = 4
#: Rows of a chunk at most, and bytes of text after which it ends.
CHUNK_ROWS = 8192
CHUNK_BYTES = 32 << 20
#: Symbols that a task turns into n-grams at a time.
SLICE = 2_000_000
QUANTILE = 0.99
PRIOR = 60
MIN_CALIBRATION = 30
#: Parts of a language's held-out documents, so that a common language isn't one task's.
SALTS = 32
ALPHABET = 1 << 16
_BEGIN, _END = 2, 3


def symbols(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """N-gram codes of texts one after another, and how many each has (its characters and its end)."""
    pad = np.full(ORDER - 1, _BEGIN, np.uint16)
    end = np.array([_END], np.uint16)
    parts, sizes = [], []
    for text in texts:
        units = np.frombuffer((text or "").encode("utf-16-le"), np.uint16)
        parts += [pad, np.maximum(units, 32), end]
        sizes.append(len(units) + 1)
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    flat = np.concatenate(parts).astype(np.uint64)
    code = np.zeros(len(flat) - ORDER + 1, np.uint64)
    for i in range(ORDER):
        code = code << np.uint64(16) | flat[i : len(flat) - ORDER + 1 + i]
    sizes = np.array(sizes, np.int64)
    # Windows that end in the next text's padding are none of its n-grams.
    return code[(code & np.uint64(0xFFFF)) != _BEGIN].view(np.int64), sizes


def slices(texts: pa.ChunkedArray):
    """Lists of texts with about SLICE characters, and where each begins."""
    own, size, begin = [], 0, 0
    for i, text in enumerate(texts.to_pylist()):
        own.append(text)
        size += len(text or "")
        if size >= SLICE:
            yield begin, own
            own, size, begin = [], 0, i + 1
    if own:
        yield begin, own


def _chunks(most_rows: int, most_bytes: int):
    """A column function: the number of the chunk within its partition, from the lengths of rows in order."""

    @F.pandas_udf("long")
    def number(lengths: Iterator[pd.Series]) -> Iterator[pd.Series]:
        chunk = rows = size = 0
        for batch in lengths:
            out = []
            for own in batch.tolist():
                if rows and (rows >= most_rows or size + own > most_bytes):
                    chunk, rows, size = chunk + 1, 0, 0
                rows, size = rows + 1, size + own
                out.append(chunk)
            yield pd.Series(out, dtype="int64")

    return number


def _gather(docs: pa.Table, trusted: pa.Table) -> pa.Table:
    """A chunk's distinct n-grams with their counts in its trusted documents."""
    train = set(trusted.column("id").to_pylist())
    flags = np.array([d in train for d in docs.column("doc_id").to_pylist()])
    keys, counts = [], []
    for begin, texts in slices(docs.column("text")):
        codes, sizes = symbols(texts)
        at, distinct = pd.factorize(codes)
        keys.append(distinct)
        counts.append(np.bincount(at, np.repeat(flags[begin : begin + len(texts)], sizes), len(distinct)))
    if not keys:
        return pa.table({"chunk": pa.array([], pa.int64()), "code": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    n = np.bincount(at, np.concatenate(counts), len(distinct)).astype(np.int64)
    return pa.table({"chunk": pa.array(np.full(len(distinct), docs.column("chunk")[0].as_py()), pa.int64()), "code": distinct, "n": n})


def _score(docs: pa.Table, answers: pa.Table) -> pa.Table:
    """Symbols and summed negative log probability of each document of a chunk."""
    keys, logs = answers.column("code").to_numpy(), answers.column("logp").to_numpy()
    order = np.argsort(keys)
    keys, logs = keys[order], logs[order]
    count, total = [], []
    for _, texts in slices(docs.column("text")):
        codes, sizes = symbols(texts)
        at, distinct = pd.factorize(codes)
        each = logs[np.searchsorted(keys, distinct)][at]
        count.append(sizes)
        total.append(-np.add.reduceat(each, np.cumsum(sizes) - sizes))
    join = lambda parts, kind: np.concatenate(parts) if parts else np.empty(0, kind)
    return pa.table({"doc_id": docs.column("doc_id"), "lang": docs.column("lang"), "n_symbols": pa.array(join(count, np.int64)), "nll": pa.array(join(total, np.float64), pa.float64())})


def _suffix(code: Column, order: int) -> Column:
    return code.bitwiseAND(F.lit((1 << 16 * order) - 1)) if order < ORDER else code


def discounts(counts_of_counts: list[int]) -> list[float]:
    """D1, D2, D3+ from the numbers of n-grams that occur one to four times."""
    n1, n2, n3, n4 = counts_of_counts
    if not (n1 and n2 and n3 and n4):
        return [0.5, 0.75, 0.9]
    y = n1 / (n1 + 2 * n2)
    return [min(max(d, 0.05), k) for k, d in ((1, 1 - 2 * y * n2 / n1), (2, 2 - 3 * y * n3 / n2), (3, 3 - 4 * y * n4 / n3))]


def probabilities(grams: DataFrame, folder: str) -> DataFrame:
    """code, logp of each distinct n-gram asked for in ``grams`` (chunk, code, n)."""
    counts = {ORDER: scratch.materialise(grams.filter("n > 0").groupBy("code").agg(F.sum("n").alias("c")), folder, f"counts_{ORDER}")}
    for k in range(ORDER - 1, 0, -1):
        counts[k] = scratch.materialise(counts[k + 1].groupBy(_suffix(F.col("code"), k).alias("code")).agg(F.count("*").alias("c")), folder, f"counts_{k}")
    asked = {ORDER: grams.select("code").distinct()}
    for k in range(ORDER - 1, 0, -1):
        asked[k] = asked[k + 1].select(_suffix(F.col("code"), k).alias("code")).distinct()

    lower: DataFrame | None = None
    for k in range(1, ORDER + 1):
        row = counts[k].agg(*(F.count_if(F.col("c") == i).alias(f"n{i}") for i in range(1, 5))).head()
        d1, d2, d3 = discounts([int(x) for x in row])
        discount = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
        context = counts[k].groupBy(F.shiftrightunsigned("code", 16).alias("context")).agg(F.sum("c").alias("total"), (F.sum(discount) / F.sum("c")).alias("gamma"))
        own = F.coalesce(F.greatest(F.col("c") - discount, F.lit(0.0)), F.lit(0.0)) / F.col("total")
        joined = asked[k].withColumn("context", F.shiftrightunsigned("code", 16)).join(counts[k], "code", "left").join(context, "context", "left")
        if lower is None:
            p_lower: Column = F.lit(1.0 / ALPHABET)
        else:
            joined = joined.withColumn("suffix", _suffix(F.col("code"), k - 1)).join(lower.select(F.col("code").alias("suffix"), F.col("p").alias("p_lower")), "suffix")
            p_lower = F.col("p_lower")
        lower = scratch.materialise(joined.select("code", F.coalesce(own + F.col("gamma") * p_lower, p_lower).alias("p")), folder, f"p_{k}")
    return lower.select("code", F.log("p").alias("logp"))


def perplexities(docs: DataFrame, trusted: DataFrame, folder: str) -> DataFrame:
    """doc_id, lang, n_symbols, nll of each row of ``docs``; the model learns from ``trusted`` (doc_id)."""
    chunk = F.shiftleft(F.spark_partition_id().cast("long"), 33) + _chunks(CHUNK_ROWS, CHUNK_BYTES)(F.octet_length(F.coalesce("text", F.lit(""))))
    columns = docs.select(chunk.alias("chunk"), F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text")
    table = scratch.bucketed(columns, folder, "chunks", scratch.shuffle_partitions(docs.sparkSession), "chunk", codec="zstd")
    ids = table.select(F.col("chunk").alias("of"), F.col("doc_id").alias("id")).join(trusted.select(F.col("doc_id").alias("id")).distinct(), "id", "left_semi")
    gathered = table.groupBy("chunk").cogroup(ids.groupBy("of")).applyInArrow(_gather, "chunk long, code long, n long")
    grams = scratch.materialise(gathered, folder, "grams")
    answers = grams.select(F.col("chunk").alias("of"), "code").join(probabilities(grams, folder), "code")
    scored = table.groupBy("chunk").cogroup(answers.groupBy("of")).applyInArrow(_score, "doc_id long, lang string, n_symbols long, nll double")
    return scratch.materialise(scored, folder, "scores")


def quality(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """doc_id, lang, n_symbols, perplexity, threshold, accepted for each row of ``docs``.

    ``labels`` (doc_id, quality, toxic) says what is trusted: quality 1 and not toxic.
    ``threshold`` bounds the drawn score, not the perplexity itself.
    """
    folder = scratch.new_folder(docs.sparkSession, "quality")
    trusted = labels.filter("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    scores = perplexities(docs, trusted.filter(~held_out(F.col("doc_id"))), folder).withColumn("mean", F.col("nll") / F.col("n_symbols"))

    def drawn(median: Column) -> Column:
        return (F.col("nll") + PRIOR * median) / (F.col("n_symbols") + PRIOR)

    def at(share: float, score: str | Column) -> Column:
        return F.percentile_approx(score, share, 10_000)

    apart = scores.join(trusted.filter(held_out(F.col("doc_id"))), "doc_id", "left_semi").withColumn("lang", F.coalesce("lang", F.lit("und")))
    middle = F.lit(apart.agg(at(0.5, "mean")).head()[0]).cast("double")
    high = F.lit(apart.agg(at(quantile, drawn(middle))).head()[0]).cast("double")
    medians = apart.groupBy("lang").agg(F.count("*").alias("n"), at(0.5, "mean").alias("median")).filter(F.col("n") >= MIN_CALIBRATION).select("lang", "median")
    salted = apart.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    spread = medians.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    by_lang = salted.join(spread, ["lang", "salt"]).groupBy(F.col("lang").alias("of")).agg(F.first("median").alias("median"), at(quantile, drawn(F.col("median"))).alias("high"))
    # A table of known size: Spark broadcasts a small one, and can split a common language's documents beside a large one.
    by_lang = scratch.materialise(by_lang, folder, "thresholds")
    joined = scores.join(by_lang, F.coalesce("lang", F.lit("und")) == F.col("of"), "left")
    threshold = F.coalesce("high", high)
    accepted = drawn(F.coalesce("median", middle)) <= threshold
    return joined.select("doc_id", "lang", "n_symbols", F.exp("mean").alias("perplexity"), F.exp(threshold).alias("threshold"), F.coalesce(accepted, F.lit(True)).alias("accepted"))
