"""Documents as they are published: fragments, the whole graph, statistics, timelines, places, source files.

What is one document for each source is built for all sources at once, one row each.
What is one document for everything (the graph, a timeline) is written as a header and
lines of items, sorted over all files, since no task should hold it; ``one_document``
puts such parts together where a reader wants a single file.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgraph.sources import fragments


def _listed(rows: DataFrame, key: str, name: str) -> DataFrame:
    """key, name: the JSON objects of rows (key, ord, json) in order, as the inside of a JSON array."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("ord", "json"))), lambda x: x["json"])
    return rows.groupBy(key).agg(F.array_join(ordered, ",").alias(name))


def _quoted(text: Column) -> Column:
    """A JSON string."""
    return F.regexp_extract(F.to_json(F.struct(text.alias("t"))), r"(?s)^\{\"t\":(.*)\}$", 1)


def fragment_documents(nodes: DataFrame, edges: DataFrame, context: str = "../context.jsonld") -> DataFrame:
    """source, slug, json: the fragment of each source, from the nodes and edges that ``process.fragments`` makes.

    The source's own node comes first, then its entities by id; relationships by subject,
    predicate and object. A null confidence is left out.
    """
    own = F.col("id") == F.col("source")
    node = F.to_json(F.struct(F.col("id").alias("@id"), F.col("type").alias("@type"), "name", F.when(~own, F.array().cast("array<string>")).alias("aliases"), F.when(~own, F.col("source")).alias("mentionedIn")))
    entities = _listed(nodes.select("source", F.struct((~own).alias("later"), "id", "name").alias("ord"), node.alias("json")), "source", "entities")
    relation = fragments.edge_json(edges.withColumn("ord", F.struct("subject", "predicate", "object", "confidence", "extracted_by")), "source")
    relationships = _listed(relation, "source", "relationships")
    joined = entities.join(relationships, "source", "left")
    parts = [F.lit(f'{{"@context":{json.dumps(context)},"@id":'), _quoted(F.col("source")), F.lit(',"entities":['), F.col("entities"), F.lit('],"relationships":['), F.coalesce("relationships", F.lit("")), F.lit("]}")]
    return joined.select("source", F.regexp_replace("source", "^source:", "").alias("slug"), F.concat(*parts).alias("json"))


def graph_statistics(counts: DataFrame, types: DataFrame, updated: str) -> DataFrame:
    """One row ``json``: the totals of ``graph.stats``, the nodes by type of ``graph.type_counts``, and when."""
    by_type = types.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("type", "n")))).alias("entities_by_type"))
    joined = counts.withColumn("k", F.lit(0)).join(by_type.withColumn("k", F.lit(0)), "k")
    return joined.select(F.to_json(F.struct("total_entities", "total_relationships", "total_sources", "entities_by_type", F.lit(updated).alias("last_updated"))).alias("json"))


def timeline_document(items: DataFrame, spans: DataFrame, generated: str) -> tuple[DataFrame, DataFrame]:
    """The header of a timeline (one row ``json``), and its items (ord, json) in order of year, start and id."""
    total = spans.agg(
        F.coalesce(F.min("min_year"), F.lit(0)).alias("min_year"),
        F.coalesce(F.max("max_year"), F.lit(0)).alias("max_year"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_items"),
        F.coalesce(F.map_from_entries(F.array_sort(F.collect_list(F.struct("precision", "n")))), F.create_map().cast("map<string,bigint>")).alias("by_precision"),
    )
    header = total.select(F.to_json(F.struct(F.lit(generated).alias("generated"), F.struct("min_year", "max_year", "total_items", "by_precision").alias("spans"))).alias("json"))
    order = F.struct(F.coalesce("year", F.lit(9999)).alias("year"), F.coalesce("iso_start", F.lit("")).alias("start"), F.col("id"))
    return header, items.select(order.alias("ord"), F.to_json(F.struct(*items.columns)).alias("json"))


def geocode_counts(results: DataFrame) -> DataFrame:
    """reason, n of geocoding results; found places have the reason ``geocoded``."""
    return results.groupBy(F.coalesce("reason", F.lit("geocoded")).alias("reason")).agg(F.count("*").alias("n"))


def geocoded_document(results: DataFrame, generated: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Statistics (one row ``json``), places and failures (ord, json) of geocoding results (id, name, lat, lng, confidence, reason)."""
    found = F.col("reason").isNull()
    counts = results.agg(F.count("*").alias("total"), F.count_if(found).alias("geocoded"), F.count_if(~found).alias("failed"))
    header = counts.select(F.to_json(F.struct(F.lit(generated).alias("generated"), F.struct("total", "geocoded", "failed").alias("stats"))).alias("json"))
    places = results.filter(found).select(F.col("id").alias("ord"), F.to_json(F.struct("id", "name", "lat", "lng", "confidence")).alias("json"))
    return header, places, results.filter(~found).select(F.col("id").alias("ord"), F.to_json(F.struct("id", "name", "reason")).alias("json"))


def source_metadata(sources: DataFrame, processed: str) -> DataFrame:
    """slug, json: the metadata of each source (slug, title, type, author, date_added, tags, description), absent values empty."""
    text = lambda c: F.coalesce(c, F.lit("")).alias(c)
    tags = F.coalesce("tags", F.array().cast("array<string>")).alias("tags")
    own = F.struct(F.col("slug").alias("source_slug"), "title", "type", text("author"), text("date_added"), tags, text("description"), F.lit("content.md").alias("content_file"), F.lit(processed).alias("processed_at"))
    return sources.select("slug", F.to_json(own).alias("json"))


def write_source_files(sources: DataFrame, texts: DataFrame, path: str, processed: str) -> None:
    """The text (slug, text) and metadata of each source in folders of its own: ``slug=.../file=content.md`` and ``.../file=metadata.json``."""
    rows = texts.select("slug", F.lit("content.md").alias("file"), F.col("text").alias("value"))
    rows = rows.union(source_metadata(sources, processed).select("slug", F.lit("metadata.json"), "json"))
    rows.repartition("slug").write.partitionBy("slug", "file").mode("overwrite").text(path)


def write_fragment_documents(documents: DataFrame, path: str) -> None:
    """Each source's fragment (slug, json) as a file in ``slug=...``; other sources' stay."""
    documents.select("slug", "json").repartition("slug").write.partitionBy("slug").option("partitionOverwriteMode", "dynamic").mode("overwrite").text(path)


def write_global(context: dict, nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """The graph below ``path``: its context, and the lines of entities and relationships in order."""
    nodes.sparkSession.createDataFrame([(json.dumps({"@context": context}),)], "json string").coalesce(1).write.mode("overwrite").text(f"{path}/context")
    fragments.write_json_lines(fragments.node_json(nodes), f"{path}/entities")
    fragments.write_json_lines(fragments.edge_json(edges), f"{path}/relationships")


def one_document(header: str, parts: dict[str, DataFrame]) -> str:
    """A JSON object of ``header`` and arrays of the rows (ord, json) of each part, for small graphs only: it comes to the driver."""
    out = json.loads(header)
    for name, rows in parts.items():
        out[name] = [json.loads(r["json"]) for r in rows.orderBy("ord").select("json").toLocalIterator()]
    return json.dumps(out, ensure_ascii=False)


# --- media of sources ------------------------------------------------------------


def thumbnails(files: DataFrame) -> DataFrame:
    """slug, thumbnail of image files (slug, root, name): in the first root (0, 1, ...) that has any, ``best_frame.png`` or else the first PNG by name."""
    pngs = files.filter(F.endswith("name", F.lit(".png")))
    best = F.min(F.struct("root", (F.col("name") != "best_frame.png").alias("other"), "name"))["name"]
    return pngs.groupBy("slug").agg(best.alias("thumbnail"))


def output_files(outputs: DataFrame) -> DataFrame:
    """slug, object, base, key, filename of output maps (slug, outputs): ``track2_name`` belongs to object 2, other keys to object 1.

    The video of all detections belongs to no object: object 0 here.
    """
    rows = outputs.select("slug", F.explode("outputs").alias("key", "filename"))
    number, rest = F.regexp_extract("key", r"^track(\d+)_(.+)$", 1), F.regexp_extract("key", r"^track(\d+)_(.+)$", 2)
    base = F.when(number != "", rest).otherwise(F.col("key"))
    object_ = F.when(number != "", number.try_cast("int")).otherwise(1)
    return rows.select("slug", F.when((object_ == 1) & (base == "debug_detections"), 0).otherwise(object_).alias("object"), base.alias("base"), "key", "filename")


def upload_map(files: DataFrame) -> DataFrame:
    """slug, urls: the address of each uploaded file (slug, name, url) by its stem."""
    stem = F.regexp_replace("name", r"\.[^.]*$", "")
    return files.groupBy("slug").agg(F.map_from_entries(F.array_sort(F.collect_set(F.struct(stem.alias("stem"), "url")))).alias("urls"))


def video_summary(videos: DataFrame) -> DataFrame:
    """slug, text: a markdown summary of each video (slug, title, frames, tracks: array of track, detections, score)."""
    line = lambda t: F.format_string("- **Object %d**: %d detections, score %.3f", t["track"], t["detections"], t["score"])
    listed = F.when(F.size("tracks") > 0, F.array_join(F.transform("tracks", line), "\n")).otherwise("No objects were tracked.")
    return videos.select("slug", F.concat(F.lit("# "), "title", F.lit("\n\n"), F.format_string("%d frames were analysed.", "frames"), F.lit("\n\n"), listed, F.lit("\n")).alias("text"))


# --- serving -------------------------------------------------------------------


def upload_status(size: Column, most: int = 104_857_600) -> Column:
    """The status of an upload: 400 without a file, 413 beyond ``most`` bytes, else 200."""
    return F.when(size.isNull(), 400).when(size > most, 413).otherwise(200)


def submit_status(title: Column, type_: Column) -> Column:
    """The status of a submission: 400 where title or type is missing or empty, else 200."""
    return F.when((F.coalesce(title, F.lit("")) == "") | (F.coalesce(type_, F.lit("")) == ""), 400).otherwise(200)


def byte_range(content: Column, header: Column) -> Column:
    """status, body, content_range of a request for ``bytes=a-b`` or ``bytes=a-`` of some bytes; the whole otherwise.

    A range that ends beyond the content is cut; one that begins beyond it has no body.
    """
    size = F.octet_length(content)
    begin = F.regexp_extract(header, r"bytes=(\d+)-(\d*)", 1).try_cast("int")
    last = F.coalesce(F.regexp_extract(header, r"bytes=(\d+)-(\d*)", 2).try_cast("int"), size - 1)
    end = F.least(last, size - 1)
    part = F.substring(content, begin + 1, F.greatest(end - begin + 1, F.lit(0)))
    told = F.format_string("bytes %d-%d/%d", begin, end, size)
    asked = begin.isNotNull()
    return F.struct(F.when(asked, 206).otherwise(200).alias("status"), F.when(asked, part).otherwise(content).alias("body"), F.when(asked, told).alias("content_range"))
