"""Derived views of a graph: degrees, previews, filters, neighbourhoods, reports, maps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docgraph.functions import names
from docgraph.functions.names import MENTIONED_IN, SOURCE_TYPE, TYPE_COLORS
from docgraph.operators.components import components
from docgraph.sources import scratch


def degrees(edges: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """id, degree, first_touch: a loop counts twice; only ``known`` ids (if given) count."""
    ends = edges.select("ord", F.posexplode(F.array("subject", "object")).alias("end", "id"))
    if known is not None:
        ends = ends.join(known.select("id"), "id", "left_semi")
    return ends.groupBy("id").agg(F.count("*").alias("degree"), F.min(F.struct("ord", "end")).alias("first_touch"))


def meaningful(edges: DataFrame, min_confidence: float) -> DataFrame:
    """Edges besides mentions; a missing confidence counts as 0."""
    return edges.filter((F.coalesce("predicate", F.lit("")) != MENTIONED_IN) & (F.coalesce("confidence", F.lit(0.0)) >= min_confidence))


def top_nodes(nodes: DataFrame, edges: DataFrame, n: int = 25, min_confidence: float = 0.5) -> DataFrame:
    """The ``n`` nodes of highest degree, ties by first touch; sources don't count."""
    known = nodes.filter(F.col("type") != SOURCE_TYPE)
    return degrees(meaningful(edges, min_confidence), known).orderBy(F.desc("degree"), "first_touch").limit(n)


def between(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """Edges both ends of which are among ``ids`` (id)."""
    edges = edges.join(ids.select(F.col("id").alias("subject")), "subject", "left_semi")
    return edges.join(ids.select(F.col("id").alias("object")), "object", "left_semi")


def preview(nodes: DataFrame, edges: DataFrame, n: int = 25, min_confidence: float = 0.5) -> DataFrame:
    """Edges among the top nodes."""
    return between(meaningful(edges, min_confidence), top_nodes(nodes, edges, n, min_confidence))


def mermaid(nodes: DataFrame, edges: DataFrame, n: int = 25, min_confidence: float = 0.5) -> DataFrame:
    """section, ord, line: the lines of a Mermaid diagram of the preview, in order of (section, ord)."""
    shown = preview(nodes, edges, n, min_confidence)
    touched = degrees(shown).select("id", "first_touch").join(nodes, "id")
    label = names.short_label(F.col("name"), F.col("type"))
    node_lines = touched.select(F.lit(1).alias("section"), F.struct("first_touch.ord", "first_touch.end").alias("ord"), F.concat(F.lit("    "), names.mermaid_id(F.col("id")), F.lit('["'), label, F.lit('"]')).alias("line"))
    arrow = F.concat(F.lit("    "), names.mermaid_id(F.col("subject")), F.lit(" -->|"), F.element_at(F.split("predicate", ":"), -1), F.lit("| "), names.mermaid_id(F.col("object")))
    return node_lines.union(shown.select(F.lit(2), F.struct("ord", F.lit(0).alias("end")), arrow))


def ui_nodes(nodes: DataFrame, counts: DataFrame) -> DataFrame:
    """Nodes as shown: color, size by mentions; sources are hidden. ``counts``: id, mention_count."""
    shown = nodes.filter(F.coalesce("type", F.lit("Thing")) != SOURCE_TYPE).join(counts.select("id", "mention_count"), "id", "left")
    mentions = F.coalesce("mention_count", F.lit(0)).cast("long")
    type_ = F.coalesce("type", F.lit("Thing"))
    fallback = F.replace(F.element_at(F.split("id", ":"), -1), F.lit("-"), F.lit(" "))
    return shown.select(
        "id",
        F.coalesce(F.when(F.col("name") != "", F.col("name")), fallback).alias("label"),
        type_.alias("type"),
        names.lookup(type_, TYPE_COLORS, F.lit(TYPE_COLORS["Thing"])).alias("color"),
        mentions.alias("mention_count"),
        F.least(F.lit(60), 20 + 5 * mentions).cast("long").alias("size"),
    )


def ui_edges(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges as shown: between shown nodes, no mentions; a missing confidence counts as 0.5."""
    shown = between(edges.filter(F.col("predicate") != MENTIONED_IN), nodes.filter(F.coalesce("type", F.lit("Thing")) != SOURCE_TYPE))
    confidence = F.coalesce("confidence", F.lit(0.5))
    return shown.select(
        F.concat_ws("-", "subject", "predicate", "object").alias("id"),
        F.col("subject").alias("source"),
        F.col("object").alias("target"),
        names.clean_predicate(F.col("predicate")).alias("label"),
        confidence.alias("confidence"),
        (1 + 3 * confidence).alias("width"),
        (0.3 + 0.7 * confidence).alias("opacity"),
    )


def node_components(edges: DataFrame) -> DataFrame:
    """id, label of the nodes that edges touch; label is a component's smallest id."""
    folder = scratch.new_folder(edges.sparkSession, "components")
    links = edges.select(F.col("subject").alias("a"), F.col("object").alias("b"))
    return components(links, folder, "graph").withColumnRenamed("node", "id")


def largest_component(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes of the largest component; of equal ones the one with the first node. Single nodes count."""
    labelled = nodes.join(node_components(edges), "id", "left").withColumn("label", F.coalesce("label", "id"))
    biggest = labelled.groupBy("label").agg(F.count("*").alias("n"), F.min("ord").alias("first")).orderBy(F.desc("n"), "first").limit(1)
    return labelled.join(biggest.select("label"), "label", "left_semi").drop("label")


def graph_view(nodes: DataFrame, edges: DataFrame, types: list[str] | None = None, min_degree: int = 3, min_confidence: float = 0.0) -> DataFrame:
    """Nodes left by the type, degree and confidence filters, of the largest component."""
    shown = nodes.filter(F.col("type") != SOURCE_TYPE)
    visible = between(edges.filter(F.col("predicate") != MENTIONED_IN), shown)
    kept = shown.join(degrees(visible).select("id", "degree"), "id", "left").withColumn("degree", F.coalesce("degree", F.lit(0)).cast("long"))
    kept = kept.filter(F.col("degree") >= min_degree)
    if types is not None:
        kept = kept.filter(F.col("type").isin(types))
    confident = between(visible.filter(F.coalesce("confidence", F.lit(0.0)) >= min_confidence), kept)
    return largest_component(kept, confident)


def search(nodes: DataFrame, query: str) -> DataFrame:
    return nodes.filter(F.contains(F.lower("name"), F.lit(query.lower())))


def neighbours(edges: DataFrame, start: DataFrame, hops: int = 1) -> DataFrame:
    """id, hop: nodes within ``hops`` edges of ``start`` (id), in either direction."""
    both = edges.select(F.col("subject").alias("a"), F.col("object").alias("b")).union(edges.select("object", "subject")).distinct()
    reached = start.select("id", F.lit(0).alias("hop"))
    edge = reached
    for hop in range(1, hops + 1):
        found = both.join(edge.select(F.col("id").alias("a")), "a", "left_semi").select(F.col("b").alias("id")).distinct()
        edge = found.join(reached, "id", "left_anti").select("id", F.lit(hop).alias("hop"))
        reached = reached.union(edge)
    return reached


# --- reports -----------------------------------------------------------------


def name_counts(nodes: DataFrame, per: list[str], n: int = 5) -> DataFrame:
    """The ``n`` most frequent names, within ``per`` if given; ties by first appearance."""
    counted = nodes.filter((F.col("type") != SOURCE_TYPE) & (F.col("name") != "")).groupBy(*per, "name").agg(F.count("*").alias("node_count"), F.min("ord").alias("first"))
    order = [F.desc("node_count"), F.asc("first")]
    if not per:
        return counted.orderBy(*order).limit(n)
    return counted.withColumn("rank", F.row_number().over(Window.partitionBy(*per).orderBy(*order))).filter(F.col("rank") <= n)


def sample_relationships(edges: DataFrame, n: int = 3) -> DataFrame:
    """The most confident edges besides mentions; a missing confidence counts as 0."""
    return edges.filter(F.col("predicate") != MENTIONED_IN).orderBy(F.desc(F.coalesce("confidence", F.lit(0.0))), "ord").limit(n)


def report_counts(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: entities, relationships, and those of low confidence (a missing one counts as 1)."""
    low = F.coalesce("confidence", F.lit(1.0)) < 0.5
    every = nodes.filter(F.col("type") != SOURCE_TYPE).select(F.lit(False).alias("edge"), F.lit(False).alias("low")).union(edges.select(F.lit(True), low))
    return every.agg(F.count_if(~F.col("edge")).alias("entities"), F.count_if("edge").alias("relationships"), F.count_if("low").alias("low_confidence"))


# --- map ---------------------------------------------------------------------


def place_adjacency(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """place, neighbour: places that an edge links, in both directions."""
    linked = between(edges, nodes.filter(F.col("type") == "Place")).filter("subject <> object")
    return linked.select(F.col("subject").alias("place"), F.col("object").alias("neighbour")).union(linked.select("object", "subject")).distinct()


def shared_edges(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """a, b, n: the number of edges between two places, once for each pair."""
    linked = between(edges, nodes.filter(F.col("type") == "Place")).filter("subject <> object")
    return linked.groupBy(F.least("subject", "object").alias("a"), F.greatest("subject", "object").alias("b")).agg(F.count("*").alias("n"))


def event_places(edges: DataFrame, geocoded: DataFrame) -> DataFrame:
    """event, place of the edges that say where an event occurred, for places with coordinates (id)."""
    occurred = edges.filter(F.contains(names.clean_predicate(F.col("predicate")), F.lit("occurred at")))
    return occurred.join(geocoded.select(F.col("id").alias("object")), "object", "left_semi").select(F.col("subject").alias("event"), F.col("object").alias("place")).distinct()


def marker_size(mentions):
    return F.least(F.lit(24), F.greatest(F.lit(8), 8 + mentions))


def place_popups(places: DataFrame, mentions: DataFrame, edges: DataFrame, n_sources: int = 5, n_neighbours: int = 4) -> DataFrame:
    """id, short_name, sources, more_sources, neighbours (label, shared) of places (id, type, display_name).

    The first sources by their place, and the first neighbouring places by their first
    edge, with the number of edges that they share.
    """
    own = places.select("id", names.short_place(F.col("display_name")).alias("short_name"))
    known = mentions.join(places.select("id"), "id", "left_semi")
    by_id = Window.partitionBy("id")
    first = known.withColumn("rank", F.row_number().over(by_id.orderBy("ord", "source"))).filter(F.col("rank") <= n_sources)
    listed = F.transform(F.array_sort(F.collect_list(F.struct("rank", "source"))), lambda m: names.pretty_id(m["source"]))
    sources = first.groupBy("id").agg(listed.alias("sources"))
    counts = known.groupBy("id").agg(F.count("*").alias("n"))
    linked = between(edges, places.filter(F.col("type") == "Place")).filter("subject <> object")
    both = linked.select(F.col("subject").alias("id"), F.col("object").alias("other"), "ord").union(linked.select("object", "subject", "ord"))
    near = both.groupBy("id", "other").agg(F.count("*").alias("shared"), F.min("ord").alias("first"))
    nearest = near.withColumn("rank", F.row_number().over(by_id.orderBy("first", "other"))).filter(F.col("rank") <= n_neighbours)
    labelled = F.transform(F.array_sort(F.collect_list(F.struct("rank", "other", "shared"))), lambda m: F.struct(names.pretty_id(m["other"]).alias("label"), m["shared"].alias("shared")))
    neighbours = nearest.groupBy("id").agg(labelled.alias("neighbours"))
    joined = own.join(sources, "id", "left").join(counts, "id", "left").join(neighbours, "id", "left")
    more = F.greatest(F.coalesce("n", F.lit(0)) - n_sources, F.lit(0)).cast("long")
    return joined.select("id", "short_name", F.coalesce("sources", F.array().cast("array<string>")).alias("sources"), more.alias("more_sources"), "neighbours")


def slug_thumbnails(slugs: DataFrame, items: DataFrame) -> DataFrame:
    """slug, thumbnail: that of the first timeline item (ord, sources, thumbnail) one of whose sources contains the slug.

    Sources and slugs meet by the slug's first three letters (all of a shorter slug).
    """
    sources = items.select("ord", "thumbnail", F.explode("sources").alias("source"))
    starts = F.sequence(F.lit(1), F.greatest(F.length("source"), F.lit(1)))
    pieces = F.transform(starts, lambda i: F.array(*(F.substr(F.col("source"), i, F.lit(n)) for n in (1, 2, 3))))
    grams = F.array_distinct(F.flatten(pieces))
    met = sources.withColumn("gram", F.explode(grams)).join(slugs.filter("slug <> ''").withColumn("gram", F.substring("slug", 1, 3)), "gram")
    hits = met.filter(F.contains("source", F.col("slug")))
    return hits.groupBy("slug").agg(F.min(F.struct("ord", "thumbnail"))["thumbnail"].alias("thumbnail"))
