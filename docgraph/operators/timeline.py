"""Timelines from date nodes and sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgraph.functions import names
from docgraph.functions.dates import parse_date
from docgraph.operators.ranking import global_rank, rank_within

#: Width of a card and the scale from which months count, in pixels (a year).
CARD_WIDTH, MONTH_SCALE = 140, 40
# Tick intervals in years, widest first, and the least pixels between ticks.
TICK_INTERVALS, TICK_PIXELS = [100, 50, 20, 10, 5, 2, 1], 50


def date_links(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """date, type, id, ord: events and places next to a date, and places that those neighbours are located or occur at.

    One row per pair, at its first edge.
    """
    types = nodes.select("id", "type")
    near = edges.join(types.filter(F.col("type") == "Date").select(F.col("id").alias("object")), "object", "left_semi").select(F.col("object").alias("date"), F.col("subject").alias("id"), "ord")
    direct = near.join(types, "id").filter(F.col("type").isin("Event", "Place")).select("date", "type", "id", "ord")
    at = edges.filter(F.contains("predicate", F.lit("occurredAt")) | F.contains("predicate", F.lit("locatedIn"))).select(F.col("subject").alias("id"), F.col("object").alias("place"))
    places = types.filter(F.col("type") == "Place").select(F.col("id").alias("place"))
    # An edge may come many times; each of them would repeat all dates of its neighbour.
    at = at.distinct().join(places, "place", "left_semi")
    beyond = near.join(at, "id").select("date", F.lit("Place").alias("type"), F.col("place").alias("id"), "ord")
    return direct.union(beyond).groupBy("date", "type", "id").agg(F.min("ord").alias("ord"))


def date_items(nodes: DataFrame, edges: DataFrame, mentions: DataFrame, sources: DataFrame) -> DataFrame:
    """Timeline items of the date nodes that can be parsed; ``sources``: source, title, type, thumbnail.

    Shown is the name of the first event; without any event the title of the first
    source; else the date's own text. The source type is that of the first source
    with a thumbnail, or of the last known source before.
    """
    own = nodes.filter(F.col("type") == "Date").select("id", F.col("name").alias("label"))
    # Each text is parsed once, and not in a filter: that would be pushed down to where the text is made and evaluated for all uses of it.
    parsed = F.filter(F.array(parse_date(F.col("label"))), lambda d: d.isNotNull())
    dates = own.join(own.select("label").distinct().select("label", F.explode(parsed).alias("d")), "label")
    links = date_links(nodes, edges).join(nodes.select("id", "name"), "id")
    linked = links.groupBy(F.col("date").alias("id")).agg(
        F.count_if(F.col("type") == "Event").alias("n_events"),
        F.count_if(F.col("type") == "Place").alias("n_places"),
        F.min(F.when(F.col("type") == "Event", F.struct("ord", "name")))["name"].alias("event_name"),
    )
    known = mentions.join(sources, "source", "left")
    order = F.struct("ord", "source")
    about = known.groupBy("id").agg(
        F.count("*").alias("n_sources"),
        F.min(F.struct("ord", "source", "title"))["title"].alias("first_title"),
        F.min(F.when(F.col("thumbnail").isNotNull(), F.struct(order.alias("o"), "type", "thumbnail"))).alias("shown"),
        F.max(F.when(F.col("type").isNotNull(), F.struct(order.alias("o"), "type")))["type"].alias("last_type"),
    )
    title = F.when(F.coalesce("n_events", F.lit(0)) == 0, F.when(F.col("first_title") != "", F.col("first_title")))
    return dates.join(linked, "id", "left").join(about, "id", "left").select(
        "id",
        F.lit("date").alias("type"),
        "label",
        F.coalesce(F.when(F.col("event_name") != "", F.col("event_name")), title, "label").alias("display_label"),
        "d.iso_start",
        "d.iso_end",
        "d.precision",
        "d.year",
        F.coalesce("shown.type", "last_type").alias("source_type"),
        F.col("shown.thumbnail").alias("thumbnail"),
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_sources", "n_events", "n_places")),
    )


def source_items(sources: DataFrame, place_mentions: DataFrame) -> DataFrame:
    """Timeline items of sources (source, slug, title, type, thumbnail, date_added) with a year in their slug or date.

    Without a title their ``label`` is shown, if they have that column, else their slug.
    """
    shown = F.coalesce("title", "label", "slug") if "label" in sources.columns else F.coalesce("title", "slug")
    places = place_mentions.groupBy("source").agg(F.count("*").alias("n_places"))
    year = F.coalesce(names.year_from_slug(F.col("slug")), F.substring("date_added", 1, 4).try_cast("int"))
    text = F.lpad(F.col("year").cast("string"), 4, "0")
    dated = sources.withColumn("year", year).filter("year <> 0")
    return dated.join(places, "source", "left").select(
        F.col("source").alias("id"),
        F.lit("source").alias("type"),
        shown.alias("label"),
        shown.alias("display_label"),
        text.alias("iso_start"),
        text.alias("iso_end"),
        F.lit("year").alias("precision"),
        "year",
        F.col("type").alias("source_type"),
        "thumbnail",
        F.lit(1).cast("long").alias("n_sources"),
        F.lit(0).cast("long").alias("n_events"),
        F.coalesce("n_places", F.lit(0)).cast("long").alias("n_places"),
    )


def timeline(nodes: DataFrame, edges: DataFrame, mentions: DataFrame, sources: DataFrame) -> DataFrame:
    """All items, to be sorted by (coalesce(year, 9999), iso_start, id)."""
    places = mentions.join(nodes.filter(F.col("type") == "Place").select("id"), "id", "left_semi")
    dates = date_items(nodes, edges, mentions, sources.select("source", "title", "type", "thumbnail"))
    return dates.unionByName(source_items(sources, places))


def spans(items: DataFrame) -> DataFrame:
    """precision, n, and the overall min_year, max_year and total_items on each row."""
    by = items.groupBy(F.coalesce("precision", F.lit("unknown")).alias("precision")).agg(F.count("*").alias("n"), F.min("year").alias("low"), F.max("year").alias("high"))
    total = by.agg(F.coalesce(F.min("low"), F.lit(0)).alias("min_year"), F.coalesce(F.max("high"), F.lit(0)).alias("max_year"), F.sum("n").alias("total_items"))
    return by.select("precision", "n", F.lit(0).alias("all")).join(total.withColumn("all", F.lit(0)), "all").drop("all")


def of_types(items: DataFrame, types: list[str] | None) -> DataFrame:
    """Items left by the filter on node types: dates with Date, sources with their own type or where no type is chosen, all others."""
    if types is None:
        return items
    date, source = F.lit("Date" in types), F.lit(names.SOURCE_TYPE in types or not types)
    return items.filter(F.when(F.col("type") == "date", date).when(F.col("type") == "source", source).otherwise(True))


def score() -> Column:
    precision = names.lookup(F.col("precision"), {"day": 3, "month": 2, "season": 1}, F.lit(0))
    return F.when(F.col("thumbnail").isNotNull(), 20).otherwise(0) + 8 * F.col("n_events") + 4 * F.col("n_places") + 2 * F.col("n_sources") + precision


def layout(items: DataFrame) -> DataFrame:
    """Items with score, rank, the side they are on (alternating within a year) and stem level."""
    in_order = [F.coalesce("year", F.lit(9999)), F.coalesce("iso_start", F.lit("")), F.col("id")]
    ranked = global_rank(items.withColumn("score", score().cast("long")), [F.desc("score"), *in_order])
    ranked = rank_within(ranked, ["year"], [F.col("rank")], "turn")
    level = F.pmod(names.rolling_hash(F.col("id")).bitwiseAND(0x7FFFFFFF), F.lit(3))
    return ranked.withColumn("above", F.col("turn") % 2 == 0).drop("turn").withColumn("stem_level", level.cast("int"))


def position(px_per_year: float) -> Column:
    month = F.try_element_at(F.split(F.coalesce("iso_start", F.lit("")), "-"), F.lit(2)).try_cast("int")
    year = F.col("year").cast("double")
    return year + F.coalesce((month - 1) / 12, F.lit(0.0)) if px_per_year >= MONTH_SCALE else year


def visible(laid_out: DataFrame, px_per_year: float) -> DataFrame:
    """The items that fit: best first, each keeps others of its side away; sources with video always show.

    Of items at one place of one side only the best can be placed, so each side comes
    down to one item per place (months of years) before the search, which is sequential.
    """
    always = (F.col("type") == "source") & F.coalesce(F.col("source_type") == "video", F.lit(False))
    placed = laid_out.withColumn("place", position(px_per_year)).withColumn("always", always).filter("place is not null")
    best = placed.groupBy("above", "place").agg(F.min(F.struct((~F.col("always")).alias("later"), "rank", "id")).alias("best"))
    distance = CARD_WIDTH / px_per_year

    def fit(pdf):
        taken: list[float] = []
        keep = []
        for row in pdf.sort_values(["later", "rank"]).itertuples():
            if not row.later or all(abs(p - row.place) >= distance for p in taken):
                taken.append(row.place)
                keep.append(row.id)
        return pdf[pdf["id"].isin(keep)][["id"]]

    chosen = best.select("above", "place", "best.later", "best.rank", "best.id").groupBy("above").applyInPandas(fit, "id string")
    return placed.join(chosen.union(placed.filter("always").select("id")).distinct(), "id", "left_semi").drop("place", "always")


def tick_interval(px_per_year: float) -> int:
    """The narrowest interval whose ticks are far enough apart; ten years if none is."""
    fitting = [i for i in TICK_INTERVALS if i * px_per_year >= TICK_PIXELS]
    return fitting[-1] if fitting else 10


def pixels_per_year(zoom: Column, least: float, most: float = 960) -> Column:
    return F.round(least * F.pow(F.lit(most / least), zoom / 100))
