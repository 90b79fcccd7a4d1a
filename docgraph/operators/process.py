"""From document text and recognised mentions to fragments: the per-document pipeline over tables.

Models come in from outside: mentions by any recogniser as a table, replies by any
completion function.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgraph.functions import markup, names, noise
from docgraph.operators import graph, resolve
from docgraph.sources import manifests


def entities_of(mentions: DataFrame, noise_terms: DataFrame | None = None) -> DataFrame:
    """source, id, label, name, ord, mention_count of recognised mentions (source, name, label, start, end).

    Noise is dropped; a name under a label is one entity, at its first place.
    """
    kept = mentions.filter(noise.is_entity_mention(F.col("name"), F.col("label")))
    if noise_terms is not None:
        kept = kept.withColumn("__bare", F.lower(names.strip(F.col("name")))).join(noise_terms.select(F.col("term").alias("__bare")), "__bare", "left_anti")
    named = kept.withColumn("name", noise.mention_name(F.col("name"), F.col("label")))
    grouped = named.groupBy("source", "name", "label").agg(F.min("start").alias("ord"), F.count("*").alias("mention_count"))
    return grouped.select("source", names.entity_id(F.col("label"), names.slug_nfkd(F.col("name"))).alias("id"), "label", "name", "ord", "mention_count")


def snippets(mentions: DataFrame, documents: DataFrame) -> DataFrame:
    """mentions with ``snippet``: the text around each of them. Documents: source, text (without markdown)."""
    return mentions.join(documents, "source").withColumn("snippet", markup.context_snippet(F.col("text"), F.col("start"), F.col("end"))).drop("text")


def chunks_with_entities(documents: DataFrame, entities: DataFrame, least: int = 2) -> DataFrame:
    """source, pos, chunk, names: pieces of documents in which ``least`` or more of their entities occur.

    A document meets its names as one list, before it is cut, so nothing is joined by piece and name.
    """
    listed = entities.groupBy("source").agg(F.array_sort(F.collect_set(F.struct("name", F.lower("name").alias("lower")))).alias("listed")).filter(F.size("listed") >= least)
    pieces = documents.join(listed, "source").select("source", "listed", F.posexplode(markup.chunks(F.col("text"))).alias("pos", "chunk"))
    found = F.filter("listed", lambda n: F.contains(F.col("lowered"), n["lower"]))
    hits = pieces.withColumn("lowered", F.lower("chunk")).withColumn("names", F.transform(found, lambda n: n["name"])).filter(F.size("names") >= least)
    return hits.select("source", "pos", "chunk", "names")


def prompt(chunk: Column, entity_names: Column) -> Column:
    """The question put to a completion function about a chunk."""
    return F.concat(
        F.lit("Which relationships between the entities below does the text state?\nEntities: "),
        F.array_join(entity_names, "; "),
        F.lit("\nPredicates: " + ", ".join(names.PREDICATES) + "\nAnswer with a JSON array of objects with subject, predicate, object and confidence.\n\n"),
        chunk,
    )


def relationships(chunks: DataFrame, entities: DataFrame, cache: DataFrame, complete: Callable[[str], str | None], model: str) -> tuple[DataFrame, DataFrame]:
    """source, subject, predicate, object, confidence, extracted_by from cached or new replies about chunks; and the grown cache."""
    asked, grown = manifests.complete(chunks.withColumn("prompt", prompt(F.col("chunk"), F.col("names"))), cache, complete, "prompt")
    rows = asked.select("source", F.explode(markup.reply_rows(F.col("value"))).alias("r")).select("source", "r.*")
    found = resolve.relationship_ids(rows, entities.select("source", "id", "name", "ord")).withColumn("extracted_by", F.lit(model))
    return found.select("source", "subject", "predicate", "object", "confidence", "extracted_by"), grown


def fragments(sources: DataFrame, entities: DataFrame, extracted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of every source (source, title)."""
    topic = graph.topics(sources, entities)
    return graph.fragment_nodes(sources, entities, topic), graph.fragment_edges(entities, extracted, topic)
