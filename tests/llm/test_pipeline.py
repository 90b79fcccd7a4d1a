"""The pipeline's stages take effect, one after the other."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from docgraph.llm import language_id, line_dedup, near_dup, packing, quality
from tests.llm.helpers import ODD_ROWS, table
from tests.llm.test_texts import brute_lines, brute_near, brute_pack


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """What each stage was given and what it made."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = []
    for i, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        made = spark.read.parquet(f"{folder}/{i}")
        out.append((docs, made))
        docs = made
    return out


def ids(df):
    return sorted(r[0] for r in df.select("doc_id").collect())


def test_stages_in_order():
    assert [n for n, _ in pipeline.STAGES] == ["quality classifier", "language ID", "line dedup", "near-duplicates", "best-fit packing"]


def test_columns_stay(stages):
    for _, made in stages[:-1]:
        assert made.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_quality_stage(spark, sf_dir, stages):
    given, made = stages[0]
    judged = quality.quality(given, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    assert ids(made) == ids(judged.filter("accepted")) and made.count() < given.count()


def test_language_stage(stages):
    given, made = stages[1]
    told = language_id.language_id(given)
    assert ids(made) == ids(told.filter("lang_pred <> 'und' and score >= 0.5"))


def test_line_stage(stages):
    given, made = stages[2]
    want = {r["doc_id"]: r["kept_text"] for r in line_dedup.line_dedup(given).collect()}
    assert {r["doc_id"]: r["text"] for r in made.collect()} == want
    assert made.filter(F.length("text") != F.col("n_chars")).count() == 0


def test_near_duplicate_stage(stages):
    given, made = stages[3]
    assert ids(made) == ids(near_dup.near_duplicates(given).filter("kept")) and made.count() < given.count()


def test_line_and_near_duplicate_stages_equal_brute_force(stages):
    rows = lambda df: [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    given, made = stages[2]
    assert dict(rows(made)) == {i: kept for i, (_, _, kept) in brute_lines(rows(given)).items()}
    given, made = stages[3]
    assert ids(made) == sorted(i for i, (_, component) in brute_near(rows(given), 5).items() if component == i)


def test_packing_stage_equals_brute_force(stages):
    given, made = stages[4]
    rows = []
    for r in given.collect():
        text = r["text"] or ""
        rows.append((r["doc_id"], max(1, len(re.findall(r"[^\x20\x09-\x0D]+", text))), r["source"], text.lower() or None))
    found = {(r["doc_id"], r["piece"]): (r["bin_id"], r["bin_offset"]) for r in made.collect()}
    assert found == brute_pack(rows, packing.CAPACITY)


def test_packing_stage(stages):
    given, made = stages[4]
    assert ids(made.filter("piece = 0")) == ids(given)
    assert made.groupBy("bin_id").agg(F.sum("n_words").alias("n")).filter(F.col("n") > packing.CAPACITY).count() == 0


def test_run_is_the_stages(spark, sf_dir, stages):
    assert sorted(map(tuple, pipeline.run(spark, sf_dir).select("doc_id", "piece", "n_words").collect())) == sorted(map(tuple, stages[-1][1].select("doc_id", "piece", "n_words").collect()))


@pytest.mark.parametrize("rows", [ODD_ROWS, []])
def test_stages_bear_odd_rows(spark, sf_dir, tmp_path, rows):
    docs = table(spark, rows)
    for i, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
    assert docs.columns[:2] == ["doc_id", "piece"]
