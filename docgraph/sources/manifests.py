"""Submission manifests, source metadata, registries, caches and noise terms as tables."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Iterator

import pandas as pd
import yaml
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docgraph.functions import names
from docgraph.sources import scratch

SOURCE_DDL = (
    "title string, type string, url string, file string, author string, date_added string, tags array<string>, description string, "
    "processing struct<start: string, end: string, scale: int, max_frames: int, frame_step: int, padding_factor: double, psf_sigma: double, save_crops: boolean>"
)
#: The kinds of submissions.
KINDS = ["pdf", "url", "account", "video"]
_FIELDS = ["title", "type", "url", "file", "author", "date_added", "description"]


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def plain(x):
        return None if x is None else x.isoformat() if isinstance(x, datetime.date) else str(x)

    for pdf in batches:
        rows = []
        for slug, text in zip(pdf["slug"], pdf["text"], strict=True):
            row = {"slug": slug, "error": None, "source": None}
            try:
                data = yaml.safe_load(text)
                if data is None:
                    row["error"] = "Empty YAML file"
                elif isinstance(data, dict) and isinstance(data.get("source"), dict):
                    own = data["source"]
                    row["source"] = {k: plain(own.get(k)) for k in _FIELDS} | {"tags": own.get("tags"), "processing": own.get("processing")}
                else:
                    row["error"] = "'source' is a required property"
            except yaml.YAMLError as e:
                row["error"] = f"Invalid YAML: {e}".split("\n")[0]
            rows.append(row)
        yield pd.DataFrame(rows, columns=["slug", "error", "source"])


def read_submissions(spark: SparkSession, path: str) -> DataFrame:
    """slug, error, source: one row per manifest; the slug is the file's stem."""
    # Spark passes over files of no bytes; one of blanks alone is an empty manifest.
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.yaml").load(path)
    stem = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]*$", "")
    rows = files.select(stem.alias("slug"), F.decode("content", "utf-8").alias("text")).filter(~F.startswith("slug", F.lit("_")))
    return rows.mapInPandas(_parse, T.StructType.fromDDL("slug string, error string").add("source", T.StructType.fromDDL(SOURCE_DDL)))


def problems(source: Column, has_file: Column, has_text: Column) -> Column:
    """The messages against a submission, in order; checks of meaning come only where its form is right."""

    def says(condition: Column, message: str) -> Column:
        return F.when(condition, F.lit(message))

    def lacks(field: str) -> Column:
        return source[field].isNull()

    kind = source["type"]
    form = [
        *(says(lacks(f), f"source: '{f}' is a required property") for f in ("title", "type", "date_added")),
        says(source["title"] == "", "source.title: '' should be non-empty"),
        F.when(~kind.isin(KINDS), F.concat(F.lit("source.type: '"), kind, F.lit("' is not one of ['pdf', 'url', 'account', 'video']"))),
        says((kind == "url") & lacks("url"), "source: 'url' is a required property"),
        says(kind.isin("pdf", "video") & lacks("file") & lacks("url"), "source: is not valid under any of the given schemas"),
    ]
    meaning = [
        F.when((kind == "pdf") & source["file"].isNotNull() & ~has_file, F.concat(F.lit("PDF file not found: "), source["file"])),
        says((kind == "video") & lacks("url"), "video type requires 'url' field"),
        says((kind == "account") & ~has_text, "Account type requires companion markdown file"),
    ]
    formal = F.array_compact(F.array(*form))
    return F.when(F.size(formal) > 0, formal).otherwise(F.array_compact(F.array(*meaning)))


def routed(submissions: DataFrame) -> DataFrame:
    """Submissions with the ``kind`` they are processed as."""
    return submissions.withColumn("kind", names.route(F.col("source.type"), F.col("source.url")))


def pending(submissions: DataFrame, done: DataFrame) -> DataFrame:
    """Submissions (slug) without a fragment (slug) yet."""
    return submissions.join(done.select("slug"), "slug", "left_anti")


def metadata_with_precedence(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows of ``first``, and those of ``second`` whose slug it lacks."""
    return first.unionByName(second.join(first.select("slug"), "slug", "left_anti"), allowMissingColumns=True)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """slug and the fields of each ``metadata.json`` below ``path``; broken files are skipped."""
    ddl = "source_slug string, title string, type string, author string, date_added string, tags array<string>, description string, content_file string, processed_at string, _corrupt_record string"
    rows = spark.read.schema(ddl).option("multiLine", True).option("mode", "PERMISSIVE").option("recursiveFileLookup", True).option("pathGlobFilter", "metadata.json").json(path)
    folder = F.element_at(F.split("_metadata.file_path", "/"), -2)
    return rows.filter("_corrupt_record is null").select(F.coalesce("source_slug", folder).alias("slug"), "title", "type", "author", "date_added", "tags", "description")


def read_noise_terms(spark: SparkSession, path: str) -> DataFrame:
    """term: lower-cased lines that are neither blank nor comments."""
    line = F.lower(names.strip(F.col("value")))
    return spark.read.text(path).select(line.alias("term")).filter((F.col("term") != "") & ~F.startswith("term", F.lit("#"))).distinct()


REGISTRY_DDL = "entities map<string, struct<name string, type string, aliases array<string>, sources array<string>>>"


def parse_registry(texts: DataFrame) -> DataFrame:
    """id, name, type, aliases, sources, ord of registry files given as ``text``; broken ones are empty."""
    parsed = F.from_json("text", REGISTRY_DDL)["entities"]
    return texts.select(F.posexplode(F.map_entries(parsed)).alias("ord", "e")).select(F.col("e.key").alias("id"), "e.value.name", "e.value.type", "e.value.aliases", "e.value.sources", F.col("ord").cast("long").alias("ord"))


def registry_json(registry: DataFrame) -> DataFrame:
    """ord, json: a line for each registry entry, the form that grows with the registry."""
    return registry.select("ord", F.to_json(F.struct("id", "name", "type", "aliases", "sources")).alias("json"))


def registry_file(registry: DataFrame) -> DataFrame:
    """One row ``json``: the registry as one object of entries by id, in order, which :func:`parse_registry` reads.

    One file is one row, so this suits registries that a reader could hold in memory.
    """
    empty = F.array().cast("array<string>")
    entry = F.struct("name", "type", F.coalesce("aliases", empty).alias("aliases"), F.coalesce("sources", empty).alias("sources"))
    listed = F.array_sort(F.collect_list(F.struct("ord", "id", entry.alias("entry"))))
    entities = F.map_from_entries(F.transform(listed, lambda e: F.struct(e["id"], e["entry"])))
    return registry.agg(F.to_json(F.struct(entities.alias("entities"))).alias("json"))


def save_registry(registry: DataFrame, path: str) -> None:
    registry_file(registry).coalesce(1).write.mode("overwrite").text(path)


def cached(requests: DataFrame, cache: DataFrame, *parts: str) -> DataFrame:
    """Requests with ``key`` and the cached ``value``, null if there is none. Cache: key, value."""
    return requests.withColumn("key", names.cache_key(*(F.col(p) for p in parts))).join(cache.select("key", "value"), "key", "left")


def complete(requests: DataFrame, cache: DataFrame, complete_one: Callable[[str], str | None], prompt: str, concurrency: int = 3) -> tuple[DataFrame, DataFrame]:
    """Requests with ``value``, and the cache (key, value) with the new replies.

    Each distinct request that the cache lacks is put to ``complete_one`` once, in at most ``concurrency``
    tasks at a time; replies are written to the shared folder before anything uses them, so
    that nothing computed later asks again. A call that fails leaves its own reply
    null and isn't cached.
    """
    spark = requests.sparkSession
    missing = cached(requests, cache, prompt).filter("value is null").groupBy("key").agg(F.min(prompt).alias("prompt"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def reply(text: str) -> str | None:
            try:
                return complete_one(text)
            except Exception:  # noqa: BLE001  one failed call must not lose the others
                return None

        for pdf in batches:
            yield pd.DataFrame({"key": pdf["key"], "value": pdf["prompt"].map(reply)})

    asked = scratch.materialise(missing.repartition(concurrency).mapInPandas(run, "key string, value string"), scratch.new_folder(spark, "replies"), "new")
    grown = cache.select("key", "value").union(asked.filter("value is not null"))
    return cached(requests, grown, prompt), grown


def put(cache: DataFrame, path: str) -> None:
    """Append the entries (key, value) that the cache below ``path`` lacks; their keys are hashes, so none is ever overwritten."""
    spark = cache.sparkSession
    try:
        known = spark.read.schema("key string, value string").parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        known = spark.createDataFrame([], "key string, value string")
    fresh = cache.select("key", "value").dropDuplicates(["key"]).join(known.select("key"), "key", "left_anti")
    scratch.materialise(fresh, scratch.new_folder(spark, "cache"), "fresh").write.mode("append").parquet(path)


def lookup_state(entry: Column) -> Column:
    """What a geocoder cache entry (JSON text) says: none, miss, hit or corrupt."""
    v = F.try_parse_json(entry)
    kind = F.schema_of_variant(v)
    return F.when(entry.isNull(), "none").when(v.isNull(), "none").when(F.is_variant_null(v), "miss").when(F.startswith(kind, F.lit("OBJECT")), "hit").otherwise("corrupt")


def is_digital(characters: Column, pages: Column, least: int = 200) -> Column:
    """Whether a PDF's own text is good enough, by its mean characters a page."""
    return characters / F.greatest(pages, F.lit(1)) >= least
