"""Reading fragment files into the graph's tables, and writing graphs as JSON-LD text."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docgraph.functions.names import resolve_id


def read_fragments(spark: SparkSession, path: str) -> DataFrame:
    """file, v: one row per ``*.jsonld`` file below ``path``; none where there are no files."""
    options = {"multiLine": True, "singleVariantColumn": "v", "pathGlobFilter": "*.jsonld"}
    try:
        return spark.read.options(**options).json(path).select(F.col("_metadata.file_name").alias("file"), "v")
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], "file string, v variant")
        raise


def _text(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "string")


def _items(fragments: DataFrame, key: str) -> DataFrame:
    """file, source, pos, item of each element of an array of the fragment."""
    listed = F.try_variant_get("v", f"$.{key}", "array<variant>")
    items = fragments.select("file", _text(F.col("v"), '$["@id"]').alias("source"), F.posexplode(listed).alias("pos", "item"))
    return items.filter("item is not null")


def _ord() -> Column:
    return F.struct("file", F.col("pos").cast("long").alias("pos")).alias("ord")


def fragment_tables(fragments: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """nodes(id, type, name, ord), mentions(id, source, ord), edges(...): see operators.graph.

    ``mentionedIn`` may be a string or an array, ends may be strings or objects.
    """
    entities = _items(fragments, "entities")
    item = F.col("item")
    nodes = entities.select(_text(item, '$["@id"]').alias("id"), _text(item, '$["@type"]').alias("type"), _text(item, "$.name").alias("name"), _ord())
    own = F.try_variant_get(item, "$.mentionedIn", "variant")
    listed = F.coalesce(F.try_variant_get(own, "$", "array<string>"), F.array(F.try_variant_get(own, "$", "string")))
    mentions = entities.filter(own.isNotNull()).select(_text(item, '$["@id"]').alias("id"), F.posexplode(listed).alias("at", "source"), "file", "pos")
    mentions = mentions.select("id", "source", F.struct("file", F.col("pos").cast("long").alias("pos"), "at").alias("ord"))
    edges = _items(fragments, "relationships").select(
        resolve_id(F.try_variant_get(item, "$.subject", "variant")).alias("subject"),
        _text(item, "$.predicate").alias("predicate"),
        resolve_id(F.try_variant_get(item, "$.object", "variant")).alias("object"),
        F.try_variant_get(item, "$.confidence", "double").alias("confidence"),
        _text(item, "$.extractedBy").alias("extracted_by"),
        F.coalesce("source", F.lit("")).alias("source"),
        _ord(),
    )
    return nodes, mentions, edges


def read_context(spark: SparkSession, path: str) -> dict:
    """The context of a file, without its own ``@context`` wrapper; empty if there is no file."""
    try:
        rows = spark.read.text(path, wholetext=True).head(1)
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return {}
        raise
    data = json.loads(rows[0][0]) if rows else {}
    return data.get("@context", data)


def node_json(nodes: DataFrame) -> DataFrame:
    """ord, json: nodes (with arrays, see operators.graph.node_documents) as published; a node in parts has a line for each."""
    published = F.to_json(F.struct(F.col("id").alias("@id"), F.col("type").alias("@type"), "name", "aliases", F.col("mentioned_in").alias("mentionedIn")))
    return nodes.select(F.struct("ord", "part").alias("ord"), published.alias("json"))


def edge_json(edges: DataFrame, *kept: str) -> DataFrame:
    """ord, json: edges as published, beside the columns ``kept``."""
    ref = lambda c: F.struct(F.col(c).alias("@id")).alias(c)
    published = F.to_json(F.struct(F.lit("woo:Relationship").alias("@type"), ref("subject"), "predicate", ref("object"), "confidence", F.col("extracted_by").alias("extractedBy")))
    return edges.select(*kept, "ord", published.alias("json"))


def write_json_lines(rows: DataFrame, path: str) -> None:
    """One JSON object per line, sorted by ``ord`` over all files."""
    rows.orderBy("ord").select("json").write.mode("overwrite").text(path)


def write_fragments(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """Nodes and edges by source, overwriting only the sources at hand."""
    for name, df in (("nodes", nodes), ("edges", edges)):
        df.write.partitionBy("source").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(f"{path}/{name}")
