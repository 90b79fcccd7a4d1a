"""Language identification by word-first backoff.

A word that training has seen is scored by its log frequency in each language.
Any other word falls back to character n-grams: the longest length of which a
known n-gram occurs in the word decides, down to single characters. A document's
score is the posterior of its best language under equal priors.

A word is a run of letters, in which combining marks may follow. The model is
fitted on a bounded sample of labelled rows: about ``per_language`` documents of
each language, picked by a hash of doc_id (all of them where there are fewer).
Tokens are kept by their total over all languages, each with its counts in all of
them: ``max_words`` words and ``max_grams`` n-grams at most, and no more than
``MAX_CELLS`` counts of either. So what is sent to tasks has a fixed bound however
many languages there are; with over 80 of them fewer words are known, and others back off.

Defined results: ``und`` with score 0 where the text is null or has no letter, or
where nothing could be learned. Ties go to the language first in order. Rows with
a null doc_id are held out. Rows repeat as in the input; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import sys
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgraph.sources import scratch

PER_LANGUAGE = 4000
MAX_WORDS = 100_000
MAX_GRAMS = 60_000
#: Counts (tokens times languages) of words, of n-grams, and of unknown words that a task remembers.
MAX_CELLS = 8_000_000
LONGEST = 5
SMOOTHING = 0.5
#: Each length that a word backs off costs its n-grams this factor.
BACKOFF = 0.4


def _ranges(categories: tuple[str, ...]) -> str:
    """The characters of some categories, as the inside of a regular expression's class."""
    own = [c for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)).startswith(categories)]
    begins = [c for i, c in enumerate(own) if not i or own[i - 1] != c - 1]
    ends = [c for i, c in enumerate(own) if i + 1 == len(own) or own[i + 1] != c + 1]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(begins, ends, strict=True))


#: Word characters that aren't letters are decimal digits, other numerals and the underscore.
_LETTER = rf"[^\W\d_{_ranges(('No', 'Nl'))}]"
#: Of text in ASCII only the letters a to z are left after lower-casing.
_ASCII_WORD = re.compile("[a-z]+")
_WORD = re.compile(rf"{_LETTER}+(?:[{_ranges(('Mn', 'Mc'))}]+{_LETTER}*)*")
_COUNT_DDL = "lang string, token string, n long"


def words_of(text: str) -> list[str]:
    """The lower-cased words of a text."""
    return (_ASCII_WORD if text.isascii() else _WORD).findall(text.lower())


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the documents that no model learns from."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "utf-8")) % 5 == 0, F.lit(True))


def grams(word: str, n: int) -> list[str]:
    padded = f"<{word}>"
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter] = defaultdict(Counter)

    def rows() -> pa.RecordBatch:
        flat = [(lang, w, n) for lang, c in counts.items() for w, n in c.items()]
        return pa.RecordBatch.from_pydict({k: [x[i] for x in flat] for i, k in enumerate(("lang", "token", "n"))}, schema=pa.schema([("lang", pa.string()), ("token", pa.string()), ("n", pa.int64())]))

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts[lang].update(words_of(text))
        if sum(map(len, counts.values())) > 500_000:
            yield rows()
            counts.clear()
    yield rows()


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter = Counter()
        for lang, word, n in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            for length in range(1, LONGEST + 1):
                for gram in grams(word, length):
                    counts[lang, gram] += n
        yield pa.RecordBatch.from_pydict({"lang": [k[0] for k in counts], "token": [k[1] for k in counts], "n": list(counts.values())}, schema=pa.schema([("lang", pa.string()), ("token", pa.string()), ("n", pa.int64())]))


class Table:
    """Log frequencies by language: ``rows[at[token]]``."""

    def __init__(self, langs: list[str], counts: list[tuple[str, str, int]]) -> None:
        column = {lang: i for i, lang in enumerate(langs)}
        self.at: dict[str, int] = {}
        for _, token, _ in counts:
            self.at.setdefault(token, len(self.at))
        rows = np.zeros((len(self.at), len(langs)))
        for lang, token, n in counts:
            rows[self.at[token], column[lang]] += n
        self.rows = np.log((rows + SMOOTHING) / (rows.sum(axis=0) + SMOOTHING * len(rows)))


class Model:
    """Log frequencies by language of known words and n-grams."""

    def __init__(self, words: list[tuple[str, str, int]], grams_: list[tuple[str, str, int]]) -> None:
        self.langs = sorted({lang for lang, _, _ in words})
        grams_ = [row for row in grams_ if row[0] in self.langs]
        self.words = Table(self.langs, words)
        by_length = defaultdict(list)
        for row in grams_:
            by_length[len(row[1])].append(row)
        self.grams = {n: Table(self.langs, rows) for n, rows in by_length.items()}

    def backed_off(self, word: str) -> np.ndarray:
        """The scores of a word that training hasn't seen."""
        for n in range(LONGEST, 0, -1):
            table = self.grams.get(n)
            found = [table.at[g] for g in grams(word, n) if g in table.at] if table else []
            if found:
                return table.rows[found].sum(axis=0) / len(found) + (LONGEST + 1 - n) * math.log(BACKOFF)
        return np.zeros(len(self.langs))


class Predictor:
    """A model with the rows of unknown words that it has met, within a bound."""

    def __init__(self, model: Model, most: int = 200_000) -> None:
        self.model, self.most = model, max(1, min(most, MAX_CELLS // max(1, len(model.langs))))
        self._forget()

    def _forget(self) -> None:
        self.at = dict(self.model.words.at)
        self.rows = np.zeros((len(self.at) + self.most, len(self.model.langs)))
        self.rows[: len(self.at)] = self.model.words.rows

    def _learn(self, word: str) -> int:
        at = self.at[word] = len(self.at)
        self.rows[at] = self.model.backed_off(word)
        return at

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = Counter(words_of(text)) if text else {}
        if not counts or not self.model.langs:
            return "und", 0.0
        total = np.zeros(len(self.model.langs))
        words = list(counts)
        # A long text goes in parts, each of which the rows have room for.
        for begin in range(0, len(words), self.most):
            part = words[begin : begin + self.most]
            if len(self.at) + len(part) > len(self.rows):
                self._forget()
            ids = [self._learn(w) if at is None else at for w, at in zip(part, map(self.at.get, part), strict=True)]
            total += np.array([counts[w] for w in part], float) @ self.rows[ids]
        odds = np.exp(total - total.max())
        best = int(np.argmax(odds))
        return self.model.langs[best], float(odds[best] / odds.sum())


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, max_words: int = MAX_WORDS, max_grams: int = MAX_GRAMS) -> Model:
    """Fit on the rows of ``docs`` (doc_id, text, lang) that are not held out."""
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    # Share of each language's rows to take, compared with a hash of doc_id in [0, 1). A small table of known size is
    # broadcast by Spark, so texts need no shuffle then; one with a great many languages isn't.
    folder = scratch.new_folder(docs.sparkSession, "language_id")
    share = scratch.materialise(usable.groupBy("lang").agg((F.lit(float(per_language)) / F.count("*")).alias("share")), folder, "shares")
    languages = max(1, share.count())
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)
    sample = usable.select("lang", "text", place.alias("place")).join(share, "lang").filter("place < share").select("lang", "text")
    words = scratch.materialise(sample.mapInArrow(_count_words, _COUNT_DDL).groupBy("lang", "token").agg(F.sum("n").alias("n")), folder, "words")
    pieces = words.mapInArrow(_count_grams, _COUNT_DDL).groupBy("lang", "token").agg(F.sum("n").alias("n"))
    most = MAX_CELLS // languages
    return Model(_most_frequent(words, min(max_words, most)), _most_frequent(pieces, min(max_grams, most)))


def _most_frequent(counts: DataFrame, limit: int) -> list[tuple[str, str, int]]:
    """The rows (lang, token, n) of the ``limit`` tokens with the highest totals over all languages."""
    totals = counts.groupBy("token").agg(F.sum("n").alias("total"), F.collect_list(F.struct("lang", "n")).alias("by"))
    rows = totals.orderBy(F.desc("total"), "token").limit(limit).select("token", F.transform("by", lambda x: x["lang"]).alias("langs"), F.transform("by", lambda x: x["n"]).alias("ns")).toArrow()
    tokens, langs, ns = (rows.column(i).to_pylist() for i in range(3))
    return [(lang, token, n) for token, own, counted in zip(tokens, langs, ns, strict=True) for lang, n in zip(own, counted, strict=True)]


_PREDICTED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])


def _predict(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predictor = Predictor(model)
        for batch in batches:
            out = [predictor.predict(text) for text in batch.column(2).to_pylist()]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64())], schema=_PREDICTED)

    return run


def language_id(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs``."""
    model = model or train(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(_predict(model), "doc_id long, held_out boolean, lang_pred string, score double")
