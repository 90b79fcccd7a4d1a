"""The queries of this package, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docgraph.llm import bpe, exact_dedup, language_id, license_scan, line_dedup, near_dup, ogg, packing, quality, warc
from docgraph.sources import scratch


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_documents(spark, sf_dir))


def op2_ogg_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ogg.read(ogg.store(_documents(spark, sf_dir)))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(_documents(spark, sf_dir))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.line_dedup(_documents(spark, sf_dir))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept_text", "utf-8"), 256).alias("kept_sha256"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(_documents(spark, sf_dir))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = warc.warc_captures(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    page = F.col("capture.metadata.fields")["page-id"].try_cast("long").alias("page_id")
    named = captures.select("capture", page, F.col("capture.response.payload_bytes").alias("n_bytes"))
    revisit = F.col("capture.response.type") == "revisit"
    return warc.resolve(named, scratch.new_folder(spark, "warc"), "page_id", "n_bytes").select(
        "page_id",
        # A revisit has no payload of its own: it was measured where it refers to.
        F.when(revisit, F.col("original.n_bytes")).otherwise(F.col("n_bytes")).alias("payload_bytes"),
        F.col("capture.response.digest").alias("payload_digest"),
        F.col("capture.response.type").alias("record_type"),
        F.when(revisit, F.col("original.page_id")).alias("refers_to"),
    )


def op8_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(_documents(spark, sf_dir), words=4)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    decoded = bpe.decode(bpe.encode(_documents(spark, sf_dir), path, pattern), path, pattern)
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_exact_dedup,
        op2_ogg_media,
        op3_language_id,
        op4_line_dedup,
        op5_quality,
        op6_license_scan,
        op7_warc,
        op8_near_dup,
        op9_packing,
        op10_bpe,
    )
}

ORACLES: dict[str, str] = {
    "op1_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
             g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
        SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
        FROM d JOIN g USING (t)""",
    "op4_line_dedup": """
        WITH l AS (
          SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                 generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
        k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
        hot AS (SELECT key, max(doc_id) AS owner FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
        m AS (SELECT k.*, coalesce(owner <> doc_id, false) AS gone FROM k LEFT JOIN hot USING (key))
        SELECT doc_id, count(*) AS n_lines, CAST(sum(gone::INT) AS BIGINT) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM m GROUP BY doc_id""",
    "op7_warc": """
        WITH p AS (SELECT page_id, sha256(coalesce(html, '')) AS digest, strlen(coalesce(html, '')) AS n FROM pages),
             f AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM p)
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
               CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
        FROM f""",
    "op8_near_dup": r"""
        WITH RECURSIVE w AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS shingle FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
        e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)),
        r(node, reached) AS (SELECT doc_id, doc_id FROM documents UNION SELECT node, b FROM r JOIN e ON e.a = reached),
        c AS (SELECT node AS doc_id, min(reached) AS component_id FROM r GROUP BY node)
        SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM c LEFT JOIN n USING (doc_id)""",
}
