"""The driver's tables seen as graphs, date texts, registries and detections; in Spark and as SQL.

Each order is a source; its lines mention a customer (Person), a supplier (Organization),
a brand (CreativeWork), the supplier's nation (Place) and the order's day (Date). Brands'
names differ between fragments, and many lines give the same edge with other
confidence, so that what comes first and what is most certain both matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docgraph.functions import names
from docgraph.functions.names import MENTIONED_IN, SOURCE_TYPE

KEYS = ["ok", "ln", "pk", "sk", "ep"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt out evenly where it comes in fewer splits than there are cores, as a single small file does.

    What follows is then done by all cores; tables of many splits stay as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def slug_sql(x: str) -> str:
    return f"trim(regexp_replace(lower({x}), '[^a-z0-9]+', '-', 'g'), '-')"


def _id(kind: str, name: Column) -> Column:
    return F.concat(F.lit(f"entity:{kind}-"), names.slug(name))


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line of an order with what it mentions and the ids of that; the keys together are unique.

    Ids are made where names are few, in the tables that lines are joined with.
    """
    t = lambda n: table(spark, sf_dir, n)
    own = spread(t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus"))
    orders = t("orders").select("o_orderkey", "o_custkey", F.date_format("o_orderdate", "MMMM d, yyyy").alias("date")).withColumn("date_id", _id("date", F.col("date")))
    customers = t("customer").select("c_custkey", F.col("c_name").alias("person"), _id("person", F.col("c_name")).alias("person_id"))
    places = t("nation").select("n_nationkey", F.col("n_name").alias("place"), _id("place", F.col("n_name")).alias("place_id"))
    suppliers = t("supplier").join(places, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.col("s_name").alias("organization"), _id("organization", F.col("s_name")).alias("organization_id"), "place", "place_id")
    works = t("part").select("p_partkey", "p_brand", _id("creativework", F.col("p_brand")).alias("work_id"))
    lines = own.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(customers, F.col("o_custkey") == F.col("c_custkey"))
    lines = lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).join(works, F.col("l_partkey") == F.col("p_partkey"))
    return lines.select(
        F.col("l_orderkey").alias("ok"),
        F.col("l_linenumber").alias("ln"),
        F.col("l_partkey").alias("pk"),
        F.col("l_suppkey").alias("sk"),
        F.col("l_extendedprice").alias("ep"),
        F.concat(F.lit("source:o-"), "l_orderkey").alias("source"),
        "person",
        "organization",
        # One brand under two spellings, which have one id.
        F.when(F.col("l_orderkey") % 3 == 0, F.upper("p_brand")).otherwise(F.col("p_brand")).alias("work"),
        "place",
        "date",
        *(f"{kind}_id" for kind, _ in _KINDS),
        F.round(1 - F.col("l_discount"), 2).alias("confidence"),
        F.concat("l_returnflag", "l_linestatus").alias("extracted_by"),
    )


BASE_SQL = """base AS (
  SELECT l_orderkey AS ok, l_linenumber AS ln, l_partkey AS pk, l_suppkey AS sk, l_extendedprice AS ep, 'source:o-' || l_orderkey AS source,
         c_name AS person, s_name AS organization, CASE WHEN l_orderkey % 3 = 0 THEN upper(p_brand) ELSE p_brand END AS work, n_name AS place,
         strftime(o_orderdate, '%B %-d, %Y') AS date, round(1 - l_discount, 2) AS confidence, l_returnflag || l_linestatus AS extracted_by
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN part ON l_partkey = p_partkey JOIN nation ON s_nationkey = n_nationkey)"""

_KINDS = [("person", "Person"), ("organization", "Organization"), ("work", "CreativeWork"), ("place", "Place"), ("date", "Date")]
_PREFIX = {"work": "creativework"}


def _ids(kind: str) -> Column:
    return F.col(f"{kind}_id")


def _id_sql(kind: str) -> str:
    return f"'entity:{_PREFIX.get(kind, kind)}-' || {slug_sql(kind)}"


def graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """nodes, mentions and edges of all fragments, unmerged (see operators.graph)."""
    rows = base(spark, sf_dir)

    def ord_of(pos: str) -> Column:
        return F.struct(*KEYS, pos).alias("ord")

    items = [F.struct(F.lit(0).alias("pos"), F.col("source").alias("id"), F.lit(SOURCE_TYPE).alias("type"), F.concat(F.lit("Order "), "ok").alias("name"))]
    items += [F.struct(F.lit(i).alias("pos"), _ids(kind).alias("id"), F.lit(type_).alias("type"), F.col(kind).alias("name")) for i, (kind, type_) in enumerate(_KINDS, 1)]
    exploded = rows.select(*KEYS, "source", F.explode(F.array(*items)).alias("e")).select(*KEYS, "source", "e.*")
    nodes = exploded.select("id", "type", "name", ord_of("pos"))
    mentions = exploded.filter("pos > 0").select("id", "source", ord_of("pos"))

    def edge(pos: int, subject: Column, predicate: str, object_: Column, confidence: Column | None = None) -> Column:
        own = F.col("confidence") if confidence is None else confidence
        by = F.col("extracted_by") if confidence is None else F.lit("pipeline")
        return F.struct(F.lit(pos).alias("pos"), subject.alias("subject"), F.lit(predicate).alias("predicate"), object_.alias("object"), own.alias("confidence"), by.alias("extracted_by"))

    one = F.lit(1.0)
    links = [
        edge(0, _ids("organization"), "woo:authored", _ids("work")),
        edge(1, _ids("person"), "woo:participatedIn", _ids("work")),
        edge(2, _ids("organization"), "woo:locatedIn", _ids("place")),
        edge(3, _ids("person"), MENTIONED_IN, F.col("source"), one),
        edge(4, _ids("work"), MENTIONED_IN, F.col("source"), one),
    ]
    edges = rows.select(*KEYS, "source", F.explode(F.array(*links)).alias("e")).select(*KEYS, "source", "e.*")
    return nodes, mentions, edges.select("subject", "predicate", "object", "confidence", "extracted_by", "source", ord_of("pos"))


_ORD_SQL = "ok, ln, pk, sk, ep, pos"
NODES_SQL = (
    BASE_SQL
    + ",\nnodes AS (SELECT source AS id, 'woo:Source' AS type, 'Order ' || ok AS name, ok, ln, pk, sk, ep, 0 AS pos, source FROM base"
    + "".join(f"\n  UNION ALL SELECT {_id_sql(kind)}, '{type_}', {kind}, ok, ln, pk, sk, ep, {i}, source FROM base" for i, (kind, type_) in enumerate(_KINDS, 1))
    + ")"
)
MERGED_NODES_SQL = NODES_SQL + f",\nmn AS (SELECT * FROM nodes QUALIFY row_number() OVER (PARTITION BY id ORDER BY {_ORD_SQL}) = 1)"
EDGES_SQL = (
    ",\nedges AS ("
    + "\n  UNION ALL ".join(
        f"SELECT {s} AS subject, '{p}' AS predicate, {o} AS object, {c} AS confidence, {by} AS extracted_by, source, ok, ln, pk, sk, ep, {i} AS pos FROM base"
        for i, (s, p, o, c, by) in enumerate(
            [
                (_id_sql("organization"), "woo:authored", _id_sql("work"), "confidence", "extracted_by"),
                (_id_sql("person"), "woo:participatedIn", _id_sql("work"), "confidence", "extracted_by"),
                (_id_sql("organization"), "woo:locatedIn", _id_sql("place"), "confidence", "extracted_by"),
                (_id_sql("person"), "woo:mentionedIn", "source", "1.0", "'pipeline'"),
                (_id_sql("work"), "woo:mentionedIn", "source", "1.0", "'pipeline'"),
            ]
        )
    )
    + ")"
)
MERGED_EDGES_SQL = (
    EDGES_SQL
    + f""",
best AS (SELECT subject, predicate, object, confidence, extracted_by FROM edges
         QUALIFY row_number() OVER (PARTITION BY subject, predicate, object ORDER BY confidence DESC, {_ORD_SQL}) = 1),
firsts AS (SELECT subject, predicate, object, source AS first_source, {_ORD_SQL} FROM edges
           QUALIFY row_number() OVER (PARTITION BY subject, predicate, object ORDER BY {_ORD_SQL}) = 1),
counted AS (SELECT subject, predicate, object, count(DISTINCT source) AS n_sources FROM edges GROUP BY ALL),
me AS (SELECT * FROM best JOIN firsts USING (subject, predicate, object) JOIN counted USING (subject, predicate, object))"""
)


# --- a graph that needs cleaning -------------------------------------------------


def dirty(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Merged nodes and edges with noise names, one name under several types, loops-to-be and orphans."""
    t = lambda n: table(spark, sf_dir, n)

    def ord_of(kind: int, key: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), key.cast("long").alias("key")).alias("ord")

    k = F.col("c_custkey")
    name = F.when(k % 50 == 0, "data").when(k % 50 == 1, "|39|2|").when(k % 50 == 2, F.concat(F.lit("Customer "), k, F.lit(","))).when(k % 50 == 3, "ab").otherwise(F.concat(F.lit("Customer "), k))
    nodes = t("customer").select(F.concat(F.lit("entity:person-"), "c_custkey").alias("id"), F.lit("Person").alias("type"), name.alias("name"), ord_of(1, k))
    s = F.col("s_suppkey")
    supplier = F.when(s % 5 == 0, F.concat(F.lit("Customer "), s)).otherwise(F.concat(F.lit("Supplier "), s))
    nodes = nodes.union(t("supplier").select(F.concat(F.lit("entity:organization-"), "s_suppkey"), F.lit("Organization"), supplier, ord_of(0, s)))
    nation = F.when(F.col("n_nationkey") % 4 == 0, F.concat(F.lit("Customer "), F.col("n_nationkey") * 5)).otherwise(F.concat(F.lit("Nation "), "n_name"))
    nodes = nodes.union(t("nation").select(F.concat(F.lit("entity:place-"), "n_nationkey"), F.lit("Place"), nation, ord_of(2, F.col("n_nationkey"))))
    month = F.date_trunc("month", "o_orderdate")
    months = t("orders").select(month.alias("m")).distinct()
    shown = F.when(F.month("m") == 1, "some January").otherwise(F.date_format("m", "MMMM yyyy"))
    nodes = nodes.union(months.select(F.concat(F.lit("entity:date-"), F.date_format("m", "yyyyMM")), F.lit("Date"), shown, ord_of(3, F.date_format("m", "yyyyMM").cast("long"))))
    sources = t("orders")
    nodes = nodes.union(sources.select(F.concat(F.lit("source:o-"), "o_orderkey"), F.lit(SOURCE_TYPE), F.concat(F.lit("Order "), "o_orderkey"), ord_of(4, F.col("o_orderkey"))))

    def edges(df: DataFrame, subject: Column, predicate: str | Column, object_: Column, kind: int, key: Column) -> DataFrame:
        return df.select(subject.alias("subject"), (F.lit(predicate) if isinstance(predicate, str) else predicate).alias("predicate"), object_.alias("object"), (F.lit(0.5) + key % 5 / 10).alias("confidence"), ord_of(kind, key))

    def node(kind: str, key: str) -> Column:
        return F.concat(F.lit(f"entity:{kind}-"), key)

    o = t("orders")
    date = F.concat(F.lit("entity:date-"), F.date_format("o_orderdate", "yyyyMM"))
    out = edges(o, node("person", "o_custkey"), F.when(F.col("o_custkey") % 3 > 0, "woo:occurredAt").otherwise(MENTIONED_IN), date, 0, F.col("o_orderkey"))
    out = out.union(edges(t("supplier"), node("organization", "s_suppkey"), "woo:locatedIn", node("place", "s_nationkey"), 1, s))
    out = out.union(edges(t("supplier"), node("organization", "s_suppkey"), "woo:relatedTo", node("person", "s_suppkey"), 2, s))
    out = out.union(edges(t("customer"), node("person", "c_custkey"), F.when(k % 7 == 0, "woo:bornIn").otherwise(MENTIONED_IN), node("place", "c_nationkey"), 3, k))
    out = out.union(edges(sources, node("person", "o_custkey"), MENTIONED_IN, F.concat(F.lit("source:o-"), "o_orderkey"), 4, F.col("o_orderkey")))
    return nodes, out


DIRTY_SQL = """dn AS (
  SELECT 'entity:person-' || c_custkey AS id, 'Person' AS type,
         CASE c_custkey % 50 WHEN 0 THEN 'data' WHEN 1 THEN '|39|2|' WHEN 2 THEN 'Customer ' || c_custkey || ',' WHEN 3 THEN 'ab' ELSE 'Customer ' || c_custkey END AS name, 1 AS kind, c_custkey AS key FROM customer
  UNION ALL SELECT 'entity:organization-' || s_suppkey, 'Organization', CASE WHEN s_suppkey % 5 = 0 THEN 'Customer ' || s_suppkey ELSE 'Supplier ' || s_suppkey END, 0, s_suppkey FROM supplier
  UNION ALL SELECT 'entity:place-' || n_nationkey, 'Place', CASE WHEN n_nationkey % 4 = 0 THEN 'Customer ' || (n_nationkey * 5) ELSE 'Nation ' || n_name END, 2, n_nationkey FROM nation
  UNION ALL SELECT DISTINCT 'entity:date-' || strftime(o_orderdate, '%Y%m'), 'Date', CASE WHEN month(o_orderdate) = 1 THEN 'some January' ELSE strftime(o_orderdate, '%B %Y') END,
                   3, CAST(strftime(o_orderdate, '%Y%m') AS BIGINT) FROM orders
  UNION ALL SELECT 'source:o-' || o_orderkey, 'woo:Source', 'Order ' || o_orderkey, 4, o_orderkey FROM orders),
de AS (
  SELECT 'entity:person-' || o_custkey AS subject, CASE WHEN o_custkey % 3 > 0 THEN 'woo:occurredAt' ELSE 'woo:mentionedIn' END AS predicate, 'entity:date-' || strftime(o_orderdate, '%Y%m') AS object,
         0.5 + o_orderkey % 5 / 10 AS confidence, 0 AS kind, o_orderkey AS key FROM orders
  UNION ALL SELECT 'entity:organization-' || s_suppkey, 'woo:locatedIn', 'entity:place-' || s_nationkey, 0.5 + s_suppkey % 5 / 10, 1, s_suppkey FROM supplier
  UNION ALL SELECT 'entity:organization-' || s_suppkey, 'woo:relatedTo', 'entity:person-' || s_suppkey, 0.5 + s_suppkey % 5 / 10, 2, s_suppkey FROM supplier
  UNION ALL SELECT 'entity:person-' || c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'woo:bornIn' ELSE 'woo:mentionedIn' END, 'entity:place-' || c_nationkey, 0.5 + c_custkey % 5 / 10, 3, c_custkey FROM customer
  UNION ALL SELECT 'entity:person-' || o_custkey, 'woo:mentionedIn', 'source:o-' || o_orderkey, 0.5 + o_orderkey % 5 / 10, 4, o_orderkey FROM orders),
noisy AS (SELECT * FROM dn WHERE type <> 'woo:Source' AND (
  length(name) <= 3 OR name IN ('data') OR name LIKE '%,' OR regexp_matches(name, '\\|.*\\|') OR (type = 'Date' AND NOT regexp_matches(name, '\\b(1[5-9]\\d{2}|20[0-2]\\d)\\b'))
  OR length(regexp_replace(name, '[^\\p{L}\\s]', '', 'g')) / length(name) < 0.5)),
n1 AS (SELECT * FROM dn WHERE id NOT IN (SELECT id FROM noisy)),
e1 AS (SELECT * FROM de WHERE subject NOT IN (SELECT id FROM noisy) AND object NOT IN (SELECT id FROM noisy)),
votes AS (SELECT name, type, count(*) AS n, CASE type WHEN 'Person' THEN 6 WHEN 'Organization' THEN 5 WHEN 'Place' THEN 4 WHEN 'Date' THEN 1 ELSE 0 END AS p
          FROM n1 WHERE type <> 'woo:Source' GROUP BY name, type),
best_type AS (SELECT name, type AS best_type FROM votes QUALIFY row_number() OVER (PARTITION BY name ORDER BY n DESC, p DESC) = 1 AND count(*) OVER (PARTITION BY name) > 1),
canon AS (SELECT name, id AS canonical, type, kind, key FROM n1 WHERE type <> 'woo:Source' QUALIFY row_number() OVER (PARTITION BY name ORDER BY kind, key) = 1),
merged AS (SELECT n1.id, canonical FROM n1 JOIN canon USING (name) WHERE n1.type <> 'woo:Source' AND n1.id <> canonical),
n2 AS (SELECT canonical AS id, coalesce(best_type, type) AS type, name FROM canon LEFT JOIN best_type USING (name)
       UNION ALL SELECT id, type, name FROM n1 WHERE type = 'woo:Source'),
moved AS (SELECT coalesce(a.canonical, subject) AS subject, predicate, coalesce(b.canonical, object) AS object, confidence, kind, key
          FROM e1 LEFT JOIN merged a ON a.id = subject LEFT JOIN merged b ON b.id = object),
e2 AS (SELECT * FROM moved WHERE subject <> object QUALIFY row_number() OVER (PARTITION BY subject, predicate, object ORDER BY kind, key) = 1),
linked AS (SELECT unnest([subject, object]) AS id FROM e2 WHERE predicate <> 'woo:mentionedIn' AND subject NOT LIKE 'source:%' AND object NOT LIKE 'source:%'),
n3 AS (SELECT * FROM n2 WHERE type = 'woo:Source' OR id IN (SELECT id FROM linked)),
e3 AS (SELECT * FROM e2 WHERE subject NOT IN (SELECT id FROM n2 EXCEPT SELECT id FROM n3) AND object NOT IN (SELECT id FROM n2 EXCEPT SELECT id FROM n3))"""


# --- texts of dates ----------------------------------------------------------------


def date_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, text: each order's day in one of sixteen styles."""
    d, y = F.col("o_orderdate"), F.year("o_orderdate")
    styles = [
        F.date_format(d, "MMMM d, yyyy"),
        F.date_format(d, "d MMMM yyyy"),
        F.date_format(d, "MMMM yyyy"),
        F.concat(F.lit("June and July "), y),
        F.concat(y, F.lit(" to "), y + 2),
        F.concat(F.lit("the late "), F.floor(y / 10) * 10, F.lit("'s")),
        F.concat(F.floor(y / 10) * 10, F.lit("s")),
        F.concat(F.lit("the spring of "), y),
        F.date_format(d, "yyyy-MM-dd"),
        F.lit("1500 to 1900"),
        F.lit("Routledge"),
        F.concat(F.lit("the year "), y),
        F.concat(F.lit("between "), y, F.lit(" and "), y - 3),
        F.concat(F.lit("Winter "), y),
        F.concat(F.lit("Niagara Falls "), y),
        F.concat(F.lit("June 1-3, "), y),
    ]
    return spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")).select(F.col("o_orderkey").alias("id"), F.element_at(F.array(*styles), (F.col("o_orderkey") % 16 + 1).cast("int")).alias("text"))


DATE_TEXTS_SQL = """date_texts AS (SELECT o_orderkey AS id, CASE o_orderkey % 16
  WHEN 0 THEN strftime(o_orderdate, '%B %-d, %Y') WHEN 1 THEN strftime(o_orderdate, '%-d %B %Y') WHEN 2 THEN strftime(o_orderdate, '%B %Y')
  WHEN 3 THEN 'June and July ' || year(o_orderdate) WHEN 4 THEN year(o_orderdate) || ' to ' || (year(o_orderdate) + 2)
  WHEN 5 THEN 'the late ' || (year(o_orderdate) // 10 * 10) || '''s' WHEN 6 THEN (year(o_orderdate) // 10 * 10) || 's' WHEN 7 THEN 'the spring of ' || year(o_orderdate)
  WHEN 8 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 9 THEN '1500 to 1900' WHEN 10 THEN 'Routledge' WHEN 11 THEN 'the year ' || year(o_orderdate)
  WHEN 12 THEN 'between ' || year(o_orderdate) || ' and ' || (year(o_orderdate) - 3) WHEN 13 THEN 'Winter ' || year(o_orderdate)
  WHEN 14 THEN 'Niagara Falls ' || year(o_orderdate) ELSE 'June 1-3, ' || year(o_orderdate) END AS text FROM orders)"""


# --- detections ----------------------------------------------------------------------


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as boxes: a user is a video, an hour a frame, one box a frame (the first event's)."""
    e = table(spark, sf_dir, "events")
    frame = (F.unix_date(F.to_date("ts")) * 24 + F.hour("ts")).cast("long")
    first = e.withColumn("frame", frame).groupBy("user_id", "frame").agg(F.min(F.struct("event_id", "value")).alias("e")).select("user_id", "frame", "e.event_id", "e.value")
    return first.select(
        F.concat(F.lit("v"), "user_id").alias("video"),
        "frame",
        (F.col("frame") % 500 + F.col("event_id") % 7 * 3).cast("double").alias("x"),
        (F.col("frame") % 300 + F.col("event_id") % 5).cast("double").alias("y"),
        (10 + F.col("event_id") % 21).cast("double").alias("w"),
        (12 + F.col("event_id") % 13).cast("double").alias("h"),
        F.lit(0.5).alias("fill_ratio"),
    )


DETECTIONS_SQL = """det AS (
  SELECT 'v' || user_id AS video, frame, CAST(frame % 500 + event_id % 7 * 3 AS DOUBLE) AS x, CAST(frame % 300 + event_id % 5 AS DOUBLE) AS y,
         CAST(10 + event_id % 21 AS DOUBLE) AS w, CAST(12 + event_id % 13 AS DOUBLE) AS h
  FROM (SELECT user_id, epoch_us(ts) // 3600000000 AS frame, event_id FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, epoch_us(ts) // 3600000000 ORDER BY event_id) = 1))"""


def crowded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as boxes once more, several a frame: a frame is four days of a user."""
    e = F.col("event_id")
    own = table(spark, sf_dir, "events").select("user_id", e, F.floor(F.unix_date(F.to_date("ts")) / 4).alias("frame"))
    return own.select(
        F.concat(F.lit("v"), "user_id").alias("video"),
        "frame",
        (e * 37 % 211).cast("double").alias("x"),
        (e * 53 % 127).cast("double").alias("y"),
        (6 + e % 25).cast("double").alias("w"),
        (7 + e % 19).cast("double").alias("h"),
        (F.lit(0.25) + e % 3 / 4).alias("fill_ratio"),
    )


CROWDED_SQL = """cr AS (SELECT 'v' || user_id AS video, CAST(floor(epoch_us(ts) / 86400000000 / 4) AS BIGINT) AS frame, CAST(event_id * 37 % 211 AS DOUBLE) AS x, CAST(event_id * 53 % 127 AS DOUBLE) AS y,
  CAST(6 + event_id % 25 AS DOUBLE) AS w, CAST(7 + event_id % 19 AS DOUBLE) AS h, 0.25 + event_id % 3 / 4 AS fill_ratio FROM events)"""


# --- registry --------------------------------------------------------------------------


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with a short form as alias, every other one under a name that nobody uses."""
    c = table(spark, sf_dir, "customer")
    listed = F.col("c_custkey") % 2 == 0
    return c.select(
        F.concat(F.when(listed, "entity:person-").otherwise("entity:unlisted-"), "c_custkey").alias("id"),
        F.lit("PERSON").alias("type"),
        F.when(listed, F.col("c_name")).otherwise(F.concat(F.lit("Unlisted "), "c_custkey")).alias("name"),
        F.array(F.concat(F.when(listed, "C").otherwise("U"), "c_custkey"), F.col("c_mktsegment")).alias("aliases"),
        F.col("c_custkey").cast("long").alias("ord"),
    )


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New entities: orders' customers under their name, alias, segment or misspelt name."""
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    k = F.col("o_orderkey") % 4
    name = F.when(k == 0, F.col("c_name")).when(k == 1, F.concat(F.lit("C"), "c_custkey")).when(k == 2, F.col("c_mktsegment")).otherwise(F.concat(F.lit("Custmer#"), F.substring("c_name", 10, 9)))
    id_ = F.when(F.col("o_orderkey") % 8 == 3, F.concat(F.lit("entity:person-"), "c_custkey")).otherwise(F.concat(F.lit("entity:new-"), "o_orderkey"))
    return o.select(id_.alias("id"), F.lit("PERSON").alias("type"), name.alias("name"), F.col("o_orderkey").alias("ord"))


REGISTRY_SQL = """reg AS (SELECT CASE WHEN c_custkey % 2 = 0 THEN 'entity:person-' ELSE 'entity:unlisted-' END || c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE 'Unlisted ' || c_custkey END AS name,
               [CASE WHEN c_custkey % 2 = 0 THEN 'C' ELSE 'U' END || c_custkey, c_mktsegment] AS aliases, c_custkey AS ord FROM customer),
arr AS (SELECT CASE WHEN o_orderkey % 8 = 3 THEN 'entity:person-' || c_custkey ELSE 'entity:new-' || o_orderkey END AS id,
               CASE o_orderkey % 4 WHEN 0 THEN c_name WHEN 1 THEN 'C' || c_custkey WHEN 2 THEN c_mktsegment ELSE 'Custmer#' || substr(c_name, 10, 9) END AS name, o_orderkey AS ord
        FROM orders JOIN customer ON o_custkey = c_custkey),
idx AS (SELECT name, id AS found FROM (SELECT unnest(list_append(aliases, name)) AS name, id, ord FROM reg) QUALIFY row_number() OVER (PARTITION BY name ORDER BY ord, id) = 1)"""
