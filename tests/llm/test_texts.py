"""Language ID, line dedup, quality, license scans, near-duplicates and packing."""

from __future__ import annotations

import itertools
import math
import random
import re
import unicodedata
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docgraph.llm import language_id, license_scan, line_dedup, near_dup, packing, quality, queries
from tests.llm.helpers import LONG, ODD_ROWS, by_id, docs, table

# --- language ID -----------------------------------------------------------------------


def test_language_held_out_accuracy(spark, sf_dir):
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    both = queries.op3_language_id(spark, sf_dir).join(d.select("doc_id", "lang"), "doc_id").filter("held_out")
    right, n = both.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).head()
    assert n > 20 and right >= 0.95


def test_language_backoff():
    model = language_id.Model([("en", "thing", 5), ("de", "ding", 5)], [("en", "th", 9), ("de", "di", 9), ("de", "d", 3), ("en", "t", 3)])
    predict = language_id.Predictor(model, most=2).predict
    assert predict("thing")[0] == "en"
    assert predict("thump")[0] == "en"  # by its two first letters
    assert predict("dab")[0] == "de"  # by a single letter
    assert predict("xyz") == ("de", 0.5)  # nothing known: the first in order
    assert predict("thump thing thaw dab than xyz ding thud")[0] == "en"  # more words than there is room for
    assert language_id.Predictor(language_id.Model([], [])).predict("a") == ("und", 0.0)


def test_language_odd_rows(spark):
    rows = language_id.language_id(table(spark, ODD_ROWS)).collect()
    assert len(rows) == len(ODD_ROWS)
    for r in rows:
        text = next(t for i, t, *_ in ODD_ROWS if i == r["doc_id"]) if r["doc_id"] is not None else None
        assert 0 <= r["score"] <= 1
        if r["doc_id"] is not None and not any(c.isalpha() for c in text or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        if r["doc_id"] is None:
            assert r["held_out"]
    assert language_id.language_id(table(spark, [])).count() == 0


def test_only_letters_make_words(spark):
    rows = [(i, "good words here", "en", "s") for i in range(10)] + [(20, "½ ² ① Ⅷ _ 12 ٣", "en", "s"), (21, "\u0301", None, "s"), (22, "Ⅷ ª", None, "s"), (23, "हिन्दी", None, "s")]
    found = by_id(language_id.language_id(table(spark, rows)))
    assert [found[i]["lang_pred"] for i in (20, 21, 22, 23)] == ["und", "und", "en", "en"]
    assert language_id.words_of("हिन्दी É\u0301a x2y ½z Ⅷ don't") == ["हिन्दी", "é\u0301a", "x", "y", "z", "don", "t"]


def plain_scores(text, model):
    """The method once more, over plain dictionaries of counts."""
    words, pieces, langs = model
    found, word = [], ""
    for c in (text or "").lower() + " ":
        if c.isalpha() or word and unicodedata.category(c) in ("Mn", "Mc"):
            word += c
        elif word:
            found.append(word)
            word = ""
    if not found:
        return {}
    size = lambda t: sum(len(t2) == t for t2 in pieces)
    total = dict.fromkeys(langs, 0.0)
    for w in found:
        for lang in langs:
            if w in words:
                total[lang] += math.log((words[w].get(lang, 0) + 0.5) / (sum(c.get(lang, 0) for c in words.values()) + 0.5 * len(words)))
                continue
            for n in range(5, 0, -1):
                known = [g for i in range(len(w) + 3 - n) if (g := f"<{w}>"[i : i + n]) in pieces]
                if known:
                    base = sum(c.get(lang, 0) for g, c in pieces.items() if len(g) == n) + 0.5 * size(n)
                    total[lang] += sum(math.log((pieces[g].get(lang, 0) + 0.5) / base) for g in known) / len(known) + (6 - n) * math.log(0.4)
                    break
    most = max(total.values())
    return {k: math.exp(v - most) / sum(math.exp(x - most) for x in total.values()) for k, v in total.items()}


def test_language_scores_equal_a_plain_scorer(spark):
    rng = random.Random(12)
    stock = {"en": ["the", "thing", "through", "now"], "de": ["der", "ding", "durch", "nun"], "xx": ["thé", "dung"]}
    rows = [(i, " ".join(rng.choices(stock[lang], k=5)), lang, "s") for i, lang in enumerate(rng.choices(list(stock), k=80))]
    rows += [(100 + i, "".join(rng.choices("thedrugnin é½ ", k=30)), None, "s") for i in range(20)]
    trained = language_id.train(table(spark, rows), max_words=8, max_grams=60)
    counts = [(lang, w) for i, t, lang, _ in rows if lang for w in t.split() if zlib.crc32(str(i).encode()) % 5]
    words, pieces = defaultdict(Counter), defaultdict(Counter)
    for lang, w in counts:
        words[w][lang] += 1
        for n in range(1, 6):
            for i in range(len(w) + 3 - n):
                pieces[f"<{w}>"[i : i + n]][lang] += 1
    first = lambda table, n: {t: table[t] for t in sorted(table, key=lambda t: (-sum(table[t].values()), t))[:n]}
    model = first(words, 8), first(pieces, 60), sorted(stock)
    assert set(trained.words.at) == set(model[0])
    found = by_id(language_id.language_id(table(spark, rows), trained))
    for i, text, *_ in rows:
        want = plain_scores(text, model)
        best = min((-round(p, 12), k) for k, p in want.items())[1] if want else "und"
        assert found[i]["lang_pred"] == best and math.isclose(found[i]["score"], want.get(best, 0.0), abs_tol=1e-9)


def test_language_model_is_bounded_with_many_languages(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MAX_CELLS", 400)
    rows = [(i, f"word{'abcdefghij'[i % 10]} common text", f"l{i % 100}", "s") for i in range(600)]
    model = language_id.train(table(spark, rows))
    assert len(model.langs) == 100 and model.words.rows.size <= 400 and "common" in model.words.at
    assert language_id.Predictor(model).most == 4


def test_language_learns_nothing_from_held_out_rows(spark):
    ids = [i for i in range(200)]
    out = {r["doc_id"] for r in docs(spark, [(i, "x") for i in ids]).filter(language_id.held_out(F.col("doc_id"))).collect()}
    assert 10 < len(out) < 90
    rows = [(i, "bonjour le monde" if i in out else "hello big world", "fr" if i in out else "en", "s") for i in ids]
    assert {r["lang_pred"] for r in language_id.language_id(table(spark, rows)).collect()} == {"en"}


# --- line dedup ------------------------------------------------------------------------


def brute_lines(rows, min_length=40, min_documents=5):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_length:
                holders[key(line)].add(i)
    out = {}
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < min_length or len(holders[key(x)]) < min_documents or max(holders[key(x)]) == i]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def test_line_dedup_equals_brute_force(spark):
    rng = random.Random(3)
    lines = [c * 45 for c in "abcdefghij"] + ["É" * 39 + "x", "É" * 40, "short", "", "  " + "A" * 45 + "\t", "z" * 39]
    rows = [(i, None if i % 50 == 0 else "\n".join(rng.choices(lines, k=rng.randint(0, 6)))) for i in range(150)]
    found = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_text"]) for r in line_dedup.line_dedup(docs(spark, rows)).collect()}
    assert found == brute_lines(rows)


@pytest.mark.parametrize("batches", [1, 3, 7])
def test_line_runs_are_whatever_the_batches(spark, tmp_path, batches):
    rng = random.Random(batches)
    rows = [(i, "\n".join(rng.choices([c * 50 for c in "abcdefghijklmnop"], k=3))) for i in range(100)]
    folder = f"file://{tmp_path}"
    hot = line_dedup.repeated_lines(line_dedup.line_hashes(docs(spark, rows), folder, 40, batches), folder).collect()
    holders = defaultdict(set)
    for i, t in rows:
        for x in t.split("\n"):
            holders[x].add(i)
    assert sorted(r["max_id"] for r in hot) == sorted(max(h) for h in holders.values() if len(h) >= 5)


def test_rows_of_one_id_are_one_document(spark):
    hot, own = "h" * 60, "o" * 60
    rows = [(1, hot), (7, hot), (7, hot), (7, f"{hot}\n{hot}"), (9, hot)]
    assert all(r["n_dropped"] == 0 for r in line_dedup.line_dedup(docs(spark, rows)).collect())
    rows += [(2, hot), (3, hot), (9, f"{own}\n{hot}")]
    found = sorted((r["doc_id"], r["n_lines"], r["n_dropped"]) for r in line_dedup.line_dedup(docs(spark, rows)).collect())
    assert found == [(1, 1, 1), (2, 1, 1), (3, 1, 1), (7, 1, 1), (7, 1, 1), (7, 2, 2), (9, 1, 0), (9, 2, 0)]


def test_line_dedup_odd_rows(spark):
    found = line_dedup.line_dedup(table(spark, ODD_ROWS)).collect()
    assert len(found) == len(ODD_ROWS)
    assert all(r["n_dropped"] == 0 for r in found)
    assert {r["n_lines"] for r in found if r["doc_id"] in (1, 2)} == {1}
    assert line_dedup.line_dedup(table(spark, [])).count() == 0
    hot = "h" * 60
    rows = [(None, hot, "en", "s")] * 3 + [(i, hot, "en", "s") for i in range(5)]
    found = line_dedup.line_dedup(table(spark, rows)).collect()
    assert sum(r["n_dropped"] for r in found) == 4 and all(r["n_dropped"] == 0 for r in found if r["doc_id"] is None)
    found = line_dedup.line_dedup(table(spark, [(i, hot, "en", "s") for i in range(4)] + [(None, hot, "en", "s")])).collect()
    assert all(r["n_dropped"] == 0 for r in found)


# --- quality ---------------------------------------------------------------------------


def reference_probabilities(texts: list[str], asked: set[tuple]) -> dict[tuple, float]:
    """Interpolated modified Kneser-Ney by the textbook, over tuples."""
    order = quality.ORDER

    def symbols(text):
        return [2] * (order - 1) + [max(32, u) for u in np.frombuffer(text.encode("utf-16-le"), np.uint16).tolist()] + [3]

    counts = {order: Counter(tuple(s[i : i + order]) for s in map(symbols, texts) for i in range(len(s) - order + 1))}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    d = {k: quality.discounts([sum(c == i for c in counts[k].values()) for i in range(1, 5)]) for k in counts}

    def p(gram):
        k = len(gram)
        if not k:
            return 1 / quality.ALPHABET
        own = {g: c for g, c in counts[k].items() if g[:-1] == gram[:-1]}
        if not own:
            return p(gram[1:])
        cut = lambda c: d[k][min(c, 3) - 1]
        total = sum(own.values())
        kept = max(own[gram] - cut(own[gram]), 0) if gram in own else 0
        return kept / total + sum(map(cut, own.values())) / total * p(gram[1:])

    return {g: p(g) for g in asked}


def test_perplexity_equals_textbook(spark, tmp_path):
    rng = random.Random(5)
    texts = {i: "".join(rng.choices("abc d", k=rng.randint(0, 30))) for i in range(12)} | {50: "xyz é😀", 51: None}
    trusted = spark.createDataFrame([(i,) for i in range(8)], "doc_id long")
    found = by_id(quality.perplexities(docs(spark, list(texts.items())), trusted, f"file://{tmp_path}"))
    codes = {}
    for i, t in texts.items():
        flat, _ = quality.symbols([t])
        codes[i] = [tuple((int(c) >> s) & 0xFFFF for s in (48, 32, 16, 0)) for c in flat.view(np.uint64)]
    p = reference_probabilities([texts[i] or "" for i in range(8)], {g for c in codes.values() for g in c})
    for i, grams in codes.items():
        assert found[i]["n_symbols"] == len(grams)
        assert math.isclose(found[i]["nll"], -sum(math.log(p[g]) for g in grams), rel_tol=1e-9)


def test_quality_separates_labels(spark, sf_dir):
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = quality.quality(d, labels).join(labels, "doc_id")
    share = {r["quality"]: r["a"] for r in rows.groupBy("quality").agg(F.avg(F.col("accepted").cast("int")).alias("a")).collect()}
    assert share[1] >= 0.97 and share[0] <= 0.5


def test_a_tiny_trusted_text_does_not_loosen_the_threshold(spark, monkeypatch):
    held = [r[0] for r in spark.range(2000).filter(language_id.held_out(F.col("id"))).limit(60).collect()]
    rows = [(i, "en", 1000, 1000 * (1.6 + k / 1000)) for k, i in enumerate(held[:-1])] + [(held[-1], "en", 8, 8 * 2.8), (9000, "en", 1000, 1000 * 2.2), (9001, "en", 1000, 1000 * 1.65), (9002, "xx", 1000, 1000 * 2.2)]
    scores = spark.createDataFrame(rows, "doc_id long, lang string, n_symbols long, nll double")
    monkeypatch.setattr(quality, "perplexities", lambda *_: scores)
    found = by_id(quality.quality(docs(spark, []), spark.createDataFrame([(i, 1, 0) for i in held], "doc_id long, quality int, toxic int")))
    assert [found[i]["accepted"] for i in (9000, 9001, 9002)] == [False, True, False]
    assert sum(not found[i]["accepted"] for i in held) <= 1


def test_quality_rejects_nearly_all_labelled_junk(spark):
    large = Path("/root/testdata/sf0.1")
    if not large.exists():
        pytest.skip("no large test tables")
    labels = spark.read.parquet(f"{large}/labels.parquet")
    rows = quality.quality(spark.read.parquet(f"{large}/documents.parquet"), labels).join(labels, "doc_id").filter("quality = 0 or toxic = 0")
    share = {r["quality"]: r["a"] for r in rows.groupBy("quality").agg(F.avg(F.col("accepted").cast("int")).alias("a")).collect()}
    assert share[0] <= 0.1 and share[1] >= 0.99


def test_quality_odd_rows(spark):
    labels = spark.createDataFrame([(4, 1, 0), (5, 1, None), (5, 1, 0), (None, 1, 0), (7, None, None)], "doc_id long, quality int, toxic int")
    rows = quality.quality(table(spark, ODD_ROWS), labels).collect()
    assert len(rows) == len(ODD_ROWS)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert all(r["accepted"] for r in quality.quality(table(spark, ODD_ROWS), none).collect())
    assert quality.quality(table(spark, []), none).count() == 0


def test_chunks_do_not_change_perplexity(spark, tmp_path, monkeypatch):
    texts = [(i, f"some text number {i} " * (i % 5)) for i in range(40)]
    trusted = spark.createDataFrame([(i,) for i in range(0, 40, 2)], "doc_id long")
    whole = by_id(quality.perplexities(docs(spark, texts), trusted, f"file://{tmp_path}/a"))
    monkeypatch.setattr(quality, "CHUNK_ROWS", 3)
    cut = by_id(quality.perplexities(docs(spark, texts), trusted, f"file://{tmp_path}/b"))
    assert all(math.isclose(whole[i]["nll"], cut[i]["nll"], rel_tol=1e-9) for i in whole)


def test_chunks_are_bounded_by_rows_and_bytes(spark, tmp_path, monkeypatch):
    """A run of long documents fills several chunks, a longer one has a chunk of its own."""
    monkeypatch.setattr(quality, "CHUNK_BYTES", 1000)
    monkeypatch.setattr(quality, "CHUNK_ROWS", 20)
    lengths = [5] * 50 + [400] * 7 + [5000] + [0] * 30
    numbers = quality._chunks(20, 1000)
    df = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "i long, n int").coalesce(1)
    found = df.select("i", "n", numbers(F.col("n")).alias("chunk")).groupBy("chunk").agg(F.sum("n").alias("n"), F.count("*").alias("rows")).collect()
    assert all(r["rows"] <= 20 and (r["n"] <= 1000 or r["rows"] == 1) for r in found) and len(found) > 8
    texts = [(i, "long text " * n) for i, n in enumerate(lengths)]
    trusted = spark.createDataFrame([(i,) for i in range(40, 60)], "doc_id long")
    cut = by_id(quality.perplexities(docs(spark, texts), trusted, f"file://{tmp_path}/a"))
    monkeypatch.undo()
    whole = by_id(quality.perplexities(docs(spark, texts), trusted, f"file://{tmp_path}/b"))
    assert all(math.isclose(whole[i]["nll"], cut[i]["nll"], rel_tol=1e-9) for i in whole)


# --- license scans -----------------------------------------------------------------------


def brute_base(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    places = [(i, label) for phrase, label in license_scan.PHRASES.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({label for _, label in places}))


def test_license_base_equals_brute_force(spark):
    rng = random.Random(7)
    words = ["GNU", "General", "public", "License", "apache", "CC", "by", "MIT", "licence", "é", "x-y", "cc-by", " ", "\n", "MIT-license", "the", "license,"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 40)))) for i in range(200)] + [(900, None), (901, "mit license " * 50_000)]
    found = by_id(license_scan.license_scan(docs(spark, rows)))
    for i, text in rows:
        r = found[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_base(text)
        assert set(r["base_labels"].split(",")) <= set(r["labels"].split(","))
    assert len(license_scan.license_scan(table(spark, ODD_ROWS)).collect()) == len(ODD_ROWS)
    assert license_scan.license_scan(table(spark, [])).count() == 0


@pytest.mark.parametrize(
    ("text", "labels", "embedded"),
    [
        ("Licensed under the Apache License, Version 2.0.", "apache,apache-2.0", ""),
        ("Some text. Licensed under the terms of the Apache License, Version 2.0\nmore", "apache,apache-2.0", ""),
        ("This file is not licensed under the Apache License, Version 2.0.", "apache", "apache-2.0"),
        ("Licensed under the Apache License, Version 2.0, except for sale.", "apache", "apache-2.0"),
        ("under the terms of the Apache License", "apache", ""),
        ("Licensed under the Apache Licence, Version 2.0.", "", ""),
        ("This work is licensed under the GNU General Public License, version 3.", "gpl,gpl-3", ""),
        ("This work is licensed under the GNU General Public License, version 4.", "gpl", ""),
        ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc-4.0", ""),
        ("Licensed under CC BY-NC-ND 4.0", "cc-by,cc-by-nc-nd-4.0", ""),
        ("Licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "cc-by-sa-4.0", ""),
        ("Licensed under CC BY 4.0.", "cc-by,cc-by-4.0", ""),
        ("Licensed under CC BY-XX 4.0.", "cc-by", ""),
        ("This software thing is released under the MIT License", "mit,mit-notice", ""),
        ("This software is released under the MIT License and a fee", "mit", "mit-notice"),
        ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software, to deal in the Software without restriction except never sell it", "", ""),
    ],
)
def test_license_templates(text, labels, embedded):
    found = license_scan.Scanner().scan(text.encode())
    assert (found[5], found[7]) == (labels, embedded)


def test_full_license_texts():
    scanner = license_scan.Scanner()
    mit = """Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
    found = scanner.scan(mit.encode())
    assert found[5] == "mit-text" and found[0] - found[8] == 4  # but for the line of copyright
    assert scanner.scan(mit.replace("sublicense", "lend").encode())[5] == ""
    assert scanner.scan(mit.replace("SOFTWARE.\n", "SOFTWARE unless sold.\n").encode())[5:8] == ("", 0.5, "mit-text")


def instances(rng, template):
    """A random text of a template, by reading its markup from left to right."""
    out, skipping = [], []
    for mark, n, choice, word in re.findall(r"<<(optional|/optional|replace (\d+)|any ([^>]+))>>|(\S+)", template):
        if mark == "optional":
            skipping.append(rng.random() < 0.5)
        elif mark == "/optional":
            skipping.pop()
        elif not any(skipping):
            out += [word] if word else [rng.choice(choice.split())] if choice else rng.choices(["foo", "this", "the"], k=rng.randint(0, int(n)))
    return out


def as_pattern(template):
    pieces = []
    for mark, n, choice, word in re.findall(r"<<(optional|/optional|replace (\d+)|any ([^>]+))>>|(\S+)", template):
        pieces.append("(?:" if mark == "optional" else ")?" if mark == "/optional" else f"{re.escape(word)} " if word else f"(?:{'|'.join(choice.split())}) " if choice else rf"(?:\S+ ){{0,{n}}}")
    return re.compile("".join(pieces))


def test_shipped_templates_equal_regular_expressions():
    rng = random.Random(11)
    scanner = license_scan.Scanner()
    patterns = [(label, as_pattern(t)) for label, own in license_scan.TEMPLATES.items() for t in own]
    every = [t for own in license_scan.TEMPLATES.values() for t in own]
    seen = Counter()
    for k in range(400):
        sentences = []
        for _ in range(rng.randint(1, 3)):
            words = instances(rng, rng.choice(every))
            if rng.random() < 0.4:
                words.insert(rng.randrange(len(words) + 1), rng.choice(["not", "this", "license"]))
            if rng.random() < 0.2:
                del words[rng.randrange(len(words))]
            sentences.append(words)
        breaks, at = {0}, 0
        for words in sentences:
            breaks.add(at := at + len(words))
        flat = [w for words in sentences for w in words]
        starts = list(itertools.accumulate((len(w) + 1 for w in flat), initial=0))
        joined = "".join(w + " " for w in flat)
        want = set()
        for label, pattern in patterns:
            for i in breaks:
                for j in breaks:
                    if i < j and pattern.fullmatch(joined[starts[i] : starts[j]]):
                        want.add(label)
        found = scanner.scan(". ".join(" ".join(w) for w in sentences).encode())
        assert set(found[5].split(",")) - set(found[4].split(",")) - {""} == want, k
        seen.update(want)
    assert set(seen) == set(license_scan.TEMPLATES)


def test_automaton_equals_regular_expression():
    template = "a <<optional>> b <<replace 2>> c <</optional>> <<any d b>> <<replace 1>> e"
    automaton = license_scan.Automaton(template)
    pattern = re.compile(r"a (b (\w ){0,2}c )?[db] (\w )?e ")
    for words in itertools.product("abcde", repeat=6):
        text = "".join(w + " " for w in words)
        want = {n for n in range(7) if pattern.fullmatch(text[: 2 * n])}
        assert set(automaton.ends([w.encode() for w in words], 0)) == want


# --- near-duplicates ----------------------------------------------------------------------


def brute_near(rows, k, threshold=80):
    sets = {}
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub(r"[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(words[j : j + k]) for j in range(max(1, len(words) - k + 1))} if words else set()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        inter = len(sets[a] & sets[b])
        if inter and 100 * inter >= threshold * (len(sets[a]) + len(sets[b]) - inter):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in sets}


def family(rng, size, edits):
    base = [f"w{rng.randrange(5000)}" for _ in range(120)]
    out = []
    for _ in range(size):
        own = list(base)
        for _ in range(rng.randint(0, edits)):
            own[rng.randrange(len(own))] = f"v{rng.randrange(5000)}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize(("words", "block", "most_blocks"), [(4, 512, 64), (5, 3, 64), (4, 3, 1), (4, 1, 0)])
def test_near_duplicates_equal_brute_force(spark, words, block, most_blocks):
    rng = random.Random(words)
    texts = [t for _ in range(4) for t in family(rng, 40, 10)] + ["a b", "A b", "a b c", "", None, "one", "x " * 50]
    rng.shuffle(texts)
    rows = list(enumerate(texts, 10))
    found = near_dup.near_duplicates(docs(spark, rows), words, block=block, most_blocks=most_blocks).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute_near(rows, words)


def test_one_id_with_several_texts_is_one_node(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    found = near_dup.near_duplicates(docs(spark, [(2, a), (3, b), (5, a), (5, b), (7, a), (8, c), (8, "short"), (9, c)]), 4).collect()
    assert {(r["doc_id"], r["component_id"]) for r in found} == {(2, 2), (3, 2), (5, 2), (7, 2), (8, 8), (9, 8)}
    assert sorted(r["n_shingles"] for r in found if r["doc_id"] == 8) == [1, 27]


def test_blocks_of_the_exact_search_are_bounded(spark, monkeypatch):
    """Twenty thousand shingles a member: blocks go by shingles, not by members alone."""
    monkeypatch.setattr(near_dup, "BLOCK_SHINGLES", 200_000)
    members = spark.range(300).select(F.lit(1).cast("long").alias("key"), "id", F.lit(20_000).cast("long").alias("size"), F.lit(0).cast("long").alias("hub"), F.lit(300).cast("long").alias("n"))
    labels = spark.createDataFrame([(0, 0), (1, 0)], "node long, label long")
    todo = near_dup._unresolved(members, labels, 512)
    assert {(r["blocks"], r["turns"]) for r in todo.collect()} == {(30, 30)} and todo.count() == 300
    assert todo.filter("asks").count() == 298
    block = todo.groupBy(F.pmod(F.xxhash64("id"), F.col("blocks"))).count()
    assert block.agg(F.max("count")).head()[0] <= 30


def test_search_finds_what_joins_components():
    rng = np.random.default_rng(4)
    base = np.unique(rng.integers(0, 1 << 62, 20_000))
    sets = [np.sort(np.concatenate([base[k * 200 :], rng.integers(0, 1 << 62, k * 200)])) for k in range(40)]
    rows = [(i, i, asks, s) for i, s in enumerate(sets) for asks in (False, True)]
    table = pa.table({"id": [r[0] for r in rows], "comp": [r[1] for r in rows], "asks": [r[2] for r in rows], "hashes": pa.array([r[3] for r in rows], pa.list_(pa.int64()))})
    found = near_dup._search(80)(table).to_pydict()
    assert len(found["a"]) == 11  # the first twelve are within reach of each other
    for a, b in zip(found["a"], found["b"], strict=True):
        inter = len(np.intersect1d(sets[a], sets[b]))
        assert 100 * inter >= 80 * (len(sets[a]) + len(sets[b]) - inter)


def test_star_misses_are_searched(spark):
    """Members similar to each other but not to the hub still end in one component."""
    base = [f"w{i}" for i in range(100)]
    far = base[:]
    far[10], far[40], far[70], far[90] = "p", "q", "r", "s"
    rows = [(1, " ".join(base)), (2, " ".join(far)), (3, " ".join([*far[:99], "t"]))]
    found = by_id(near_dup.near_duplicates(docs(spark, rows), 4))
    assert {i: r["component_id"] for i, r in found.items()} == {i: c for i, (_, c) in brute_near(rows, 4).items()}


def test_near_duplicates_odd_rows(spark):
    found = near_dup.near_duplicates(table(spark, ODD_ROWS)).collect()
    assert len(found) == len(ODD_ROWS)
    own = {r["doc_id"]: r for r in found if r["doc_id"] is not None}
    assert own[6]["component_id"] == 5 and not own[6]["kept"] and own[5]["kept"]
    assert all(own[i]["n_shingles"] == 0 and own[i]["component_id"] == i for i in (1, 2, 3))
    assert all(r["component_id"] is None and r["kept"] for r in found if r["doc_id"] is None)
    assert near_dup.near_duplicates(table(spark, [])).count() == 0


def test_signature_estimates_similarity():
    rng = np.random.default_rng(1)
    common, a, b = (rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (60, 20, 20))
    x, y = (near_dup.COARSE.signature(np.unique(np.concatenate([common, z]))) for z in (a, b))
    assert abs((x == y).mean() - 0.6) < 0.15
    assert (near_dup.COARSE.signature(common[:1]) == common[0]).all()


# --- packing -------------------------------------------------------------------------------


def brute_pack(rows, capacity):
    """Every item looks at all bins: the tightest compatible one, the oldest of equals."""
    items = []
    for doc_id, length, source, cluster in rows:
        sizes = [capacity] * (length // capacity) + ([length % capacity] if length % capacity else [])
        items += [(-n, doc_id is not None, doc_id or 0, p, source, cluster) for p, n in enumerate(sizes)]
    bins, out = [], {}
    for minus, _, doc_id, piece, source, cluster in sorted(items, key=lambda x: x[:4]):
        fitting = [b for b in bins if b["left"] >= -minus and (source is None or source not in b["s"]) and (cluster is None or cluster not in b["c"])]
        best = min(fitting, key=lambda b: (b["left"], b["n"]), default=None)
        if best is None:
            best = {"n": len(bins), "left": capacity, "s": set(), "c": set()}
            bins.append(best)
        out[doc_id, piece] = (best["n"], capacity - best["left"])
        best["left"] += minus
        best["s"].add(source)
        best["c"].add(cluster)
    return out


@pytest.mark.parametrize("seed", range(5))
def test_packing_equals_brute_force(seed):
    rng = random.Random(seed)
    rows = [(i, rng.randint(1, 250), rng.choice([None, "a", "a", "b", "c", "d"]), rng.choice([None, i, rng.randrange(5)])) for i in range(300)]
    packed = packing.pack_rows(rows, 100)
    assert {(r[0], r[1]): (r[4], r[5]) for r in packed} == brute_pack(rows, 100)


def test_packing_keeps_everything_and_all_constraints(spark):
    rng = random.Random(2)
    texts = [("w " * rng.randint(0, 300)).strip() for _ in range(200)]
    rows = [(i, t, "en", "hot" if i % 3 == 0 else f"s{i % 7}") for i, t in enumerate(texts)] + [(500, LONG, "en", "hot"), (501, texts[3], "en", "x"), (502, texts[3].upper(), "en", "y")]
    packed = packing.pack(table(spark, rows), capacity=128, shard_rows=50).collect()
    length = {i: max(1, len(t.split())) for i, t, *_ in rows}
    source = {r[0]: r[3] for r in rows}
    total = Counter()
    bins = defaultdict(list)
    for r in packed:
        assert r["first_word"] == r["piece"] * 128 and r["bin_offset"] + r["n_words"] <= 128
        total[r["doc_id"]] += r["n_words"]
        bins[r["bin_id"]].append(r)
    assert total == length
    for own in bins.values():
        spans = sorted((r["bin_offset"], r["n_words"]) for r in own)
        assert all(a + n <= b for (a, n), (b, _) in itertools.pairwise(spans))
        assert len({source[r["doc_id"]] for r in own}) == len(own)


def test_packing_in_shards_equals_brute_force(spark):
    rng = random.Random(9)
    rows = [(i, ("w " * rng.randint(1, 90)).strip(), "en", rng.choice(["hot", "hot", "a", "b", None])) for i in range(300)]
    found = packing.pack(table(spark, rows), capacity=100, shard_rows=70).collect()
    shard = {r["doc_id"]: r["s"] for r in table(spark, rows).select("doc_id", F.pmod(F.xxhash64("doc_id", "text"), F.lit(5)).alias("s")).collect()}
    assert len(set(shard.values())) == 5
    for k in range(5):
        own = [(i, len(t.split()), source, t) for i, t, _, source in rows if shard[i] == k]
        assert {(r["doc_id"], r["piece"]): (r["bin_id"] - (k << 32), r["bin_offset"]) for r in found if shard[r["doc_id"]] == k} == brute_pack(own, 100)


def test_packing_odd_rows(spark):
    packed = packing.pack(table(spark, ODD_ROWS)).collect()
    assert sum(r["piece"] == 0 for r in packed) == len(ODD_ROWS)
    assert sum(r["n_words"] for r in packed if r["doc_id"] == 5) == len(LONG.split())
    assert packing.pack(table(spark, [])).count() == 0
