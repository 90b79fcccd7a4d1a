"""Queries that build, merge and clean the graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docgraph.operators import graph
from docgraph.plans import projections as p
from docgraph.plans.registering import Query, filing
from docgraph.sources import scratch
from docgraph.streaming import incremental

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
query = filing(QUERIES, ORACLES)


@query(f"WITH {p.MERGED_NODES_SQL} SELECT id, type, name, ok AS first_order FROM mn")
def merge_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, _, _ = p.graph(spark, sf_dir)
    return graph.merge_nodes(nodes).select("id", "type", "name", F.col("ord.ok").alias("first_order"))


@query(f"""WITH {p.NODES_SQL},
m AS (SELECT id, source, ok, ln, pk, sk, ep, pos FROM nodes WHERE pos > 0 QUALIFY row_number() OVER (PARTITION BY id, source ORDER BY ok, ln, pk, sk, ep, pos) = 1)
SELECT id, count(*) AS mention_count, arg_min(source, (ok, ln, pk, sk, ep, pos)) AS first_source FROM m GROUP BY id""")
def merge_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, mentions, _ = p.graph(spark, sf_dir)
    return graph.mention_counts(graph.merge_mentions(mentions))


@query(f"WITH {p.BASE_SQL}{p.MERGED_EDGES_SQL} SELECT subject, predicate, object, confidence, extracted_by, n_sources, first_source FROM me")
def merge_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, edges = p.graph(spark, sf_dir)
    return graph.merge_edges(edges).drop("ord")


@query(f"""WITH {p.MERGED_NODES_SQL}{p.MERGED_EDGES_SQL}
SELECT (SELECT count(*) FROM mn) AS total_entities, (SELECT count(*) FROM me) AS total_relationships, (SELECT count(DISTINCT source) FROM nodes WHERE pos > 0) AS total_sources""")
def graph_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, mentions, edges = p.graph(spark, sf_dir)
    return graph.stats(nodes.select("id").distinct(), edges.select("subject", "predicate", "object").distinct(), mentions)


@query(f"WITH {p.MERGED_NODES_SQL} SELECT type, count(*) AS n FROM mn GROUP BY type")
def graph_stats_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, _, _ = p.graph(spark, sf_dir)
    return graph.type_counts(graph.merge_nodes(nodes))


@query(f"""WITH {p.MERGED_NODES_SQL},
m AS (SELECT id, source, min((ok, ln, pk, sk, ep, pos)) AS o FROM nodes WHERE pos > 0 GROUP BY id, source),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY o, source) - 1 AS n FROM m)
SELECT mn.id, mn.name, coalesce(n // 1000, 0) AS part, md5(coalesce(string_agg(r.source, ',' ORDER BY n), '')) AS mentioned_in FROM mn LEFT JOIN r ON r.id = mn.id GROUP BY ALL""")
def node_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes with their ordered sources in parts of a thousand, as published (a digest of each list)."""
    nodes, mentions, _ = p.graph(spark, sf_dir)
    published = graph.node_documents(graph.merge_nodes(nodes), graph.merge_mentions(mentions), 1000)
    return published.select("id", "name", "part", F.md5(F.array_join("mentioned_in", ",")).alias("mentioned_in"))


@query(f"WITH {p.DIRTY_SQL} SELECT id, type, name FROM n1")
def clean_noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.drop_noise(*p.dirty(spark, sf_dir))[0].select("id", "type", "name")


@query(f"WITH {p.DIRTY_SQL} SELECT subject, predicate, object, round(confidence, 6) AS confidence FROM e1")
def clean_noise_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.drop_noise(*p.dirty(spark, sf_dir))[1].select("subject", "predicate", "object", F.round("confidence", 6).alias("confidence"))


@query(f"WITH {p.DIRTY_SQL} SELECT name, best_type FROM best_type")
def type_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.type_votes(graph.drop_noise(*p.dirty(spark, sf_dir))[0])


@query(f"WITH {p.DIRTY_SQL} SELECT id, type, name FROM n2")
def name_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.merge_names(graph.drop_noise(*p.dirty(spark, sf_dir))[0])[0].select("id", "type", "name")


@query(f"WITH {p.DIRTY_SQL} SELECT id, canonical FROM merged")
def merged_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.merge_names(graph.drop_noise(*p.dirty(spark, sf_dir))[0])[1]


@query(f"WITH {p.DIRTY_SQL} SELECT subject, predicate, object, round(confidence, 6) AS confidence FROM e2")
def edge_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, edges = graph.drop_noise(*p.dirty(spark, sf_dir))
    return graph.rewrite_edges(edges, graph.merge_names(nodes)[1]).select("subject", "predicate", "object", F.round("confidence", 6).alias("confidence"))


@query(f"WITH {p.DIRTY_SQL} SELECT id, type, name FROM n3")
def clean_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.clean(*p.dirty(spark, sf_dir))[0].select("id", "type", "name")


@query(f"WITH {p.DIRTY_SQL} SELECT subject, predicate, object FROM e3")
def drop_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.clean(*p.dirty(spark, sf_dir))[1].select("subject", "predicate", "object")


@query(f"WITH {p.DIRTY_SQL} SELECT type, count(*) AS n FROM n3 GROUP BY type")
def clean_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.type_counts(graph.clean(*p.dirty(spark, sf_dir))[0])


# Verdicts: labels stand for what a model said about customers.
_VERDICT_SQL = "gone AS (SELECT DISTINCT 'entity:person-' || doc_id AS id FROM labels WHERE toxic = 1)"


def _removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.table(spark, sf_dir, "labels").filter("toxic = 1").select(F.concat(F.lit("entity:person-"), "doc_id").alias("id")).distinct()


@query(f"WITH {p.DIRTY_SQL}, {_VERDICT_SQL} SELECT id, name FROM dn WHERE id NOT IN (SELECT id FROM gone)")
def verdict_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, edges = p.dirty(spark, sf_dir)
    return graph.apply_removals(nodes, edges, _removed(spark, sf_dir))[0].select("id", "name")


@query(f"WITH {p.DIRTY_SQL}, {_VERDICT_SQL} SELECT subject, predicate, object FROM de WHERE subject NOT IN (SELECT id FROM gone) AND object NOT IN (SELECT id FROM gone)")
def verdict_apply_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, edges = p.dirty(spark, sf_dir)
    return graph.apply_removals(nodes, edges, _removed(spark, sf_dir))[1].select("subject", "predicate", "object")


def _groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers of one nation are variants of its first one."""
    s = p.table(spark, sf_dir, "supplier")
    first = s.groupBy("s_nationkey").agg(F.min("s_suppkey").alias("first"))
    node = lambda c: F.concat(F.lit("entity:organization-"), c)
    return s.join(first, "s_nationkey").select(node("s_suppkey").alias("id"), node("first").alias("canonical"), F.concat(F.lit("Group "), "s_nationkey").alias("canonical_name"))


_GROUPS_SQL = """groups AS (SELECT 'entity:organization-' || s_suppkey AS id, 'entity:organization-' || min(s_suppkey) OVER (PARTITION BY s_nationkey) AS canonical,
                                   'Group ' || s_nationkey AS canonical_name FROM supplier),
mg AS (SELECT id, canonical FROM groups WHERE id <> canonical)"""


@query(f"""WITH {p.DIRTY_SQL}, {_VERDICT_SQL}, {_GROUPS_SQL}
SELECT dn.id, coalesce(c.canonical_name, name) AS name FROM dn LEFT JOIN (SELECT DISTINCT canonical, canonical_name FROM groups) c ON c.canonical = dn.id
WHERE dn.id NOT IN (SELECT id FROM gone) AND dn.id NOT IN (SELECT id FROM mg)""")
def merge_orgs_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, edges = p.dirty(spark, sf_dir)
    return graph.apply_groups(nodes, edges, _groups(spark, sf_dir), _removed(spark, sf_dir))[0].select("id", "name")


@query(f"""WITH {p.DIRTY_SQL}, {_VERDICT_SQL}, {_GROUPS_SQL},
mv AS (SELECT coalesce(a.canonical, subject) AS subject, predicate, coalesce(b.canonical, object) AS object FROM de LEFT JOIN mg a ON a.id = subject LEFT JOIN mg b ON b.id = object)
SELECT DISTINCT subject, predicate, object FROM mv WHERE subject <> object AND subject NOT IN (SELECT id FROM gone) AND object NOT IN (SELECT id FROM gone)""")
def merge_orgs_apply_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, edges = p.dirty(spark, sf_dir)
    return graph.apply_groups(nodes, edges, _groups(spark, sf_dir), _removed(spark, sf_dir))[1].select("subject", "predicate", "object")


# People whose names are given names and market segments, so that surnames repeat.
def _people(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    given = F.element_at(F.array(F.lit("Ann"), F.lit("J. R."), F.lit("Bo")), (k % 3 + 1).cast("int"))
    name = F.when(k % 11 == 0, "J. R. R.").when(k % 13 == 0, F.concat(given, F.lit(" McDonald"))).otherwise(F.concat(given, F.lit(" "), F.initcap("c_mktsegment"), F.when(k % 5 == 0, ",").otherwise("")))
    return p.table(spark, sf_dir, "customer").select(F.concat(F.lit("entity:person-"), "c_custkey").alias("id"), F.lit("Person").alias("type"), name.alias("name"), k.alias("ord"))


@query("""WITH pe AS (SELECT 'entity:person-' || c_custkey AS id, CASE WHEN c_custkey % 11 = 0 THEN 'J. R. R.' WHEN c_custkey % 13 = 0 THEN ['Ann', 'J. R.', 'Bo'][c_custkey % 3 + 1] || ' McDonald'
  ELSE ['Ann', 'J. R.', 'Bo'][c_custkey % 3 + 1] || ' ' || upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) || CASE WHEN c_custkey % 5 = 0 THEN ',' ELSE '' END END AS name FROM customer),
s AS (SELECT *, string_split(name, ' ')[-1] AS surname FROM pe WHERE NOT regexp_matches(name, '^([A-Z]\\.?\\s*)+$')),
g AS (SELECT * FROM s WHERE length(surname) > 2 AND regexp_matches(surname, '^[A-Z][^A-Z]+$') QUALIFY count(*) OVER (PARTITION BY surname) > 1)
SELECT surname, id, name FROM g""")
def surname_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.people_groups(_people(spark, sf_dir)).select("surname", "id", "name")


@query("""SELECT 'entity:person-' || c_custkey AS id, c_mktsegment AS segment, (row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) - 1) // 30 AS batch FROM customer""")
def verdict_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = p.table(spark, sf_dir, "customer").select(F.concat(F.lit("entity:person-"), "c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"), "c_custkey")
    return graph.batches(c, [F.col("c_custkey")], 30, ["segment"]).select("id", "segment", "batch")


# Replies about people who share a surname: two given names are one person, a third isn't a person.
def _people_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    surnames = graph.people_groups(_people(spark, sf_dir)).select("surname").distinct()
    s = F.col("surname")
    reply = F.format_string(
        '{"surname": "%s", "groups": [["Ann %s", "J. R. %s", "Nobody"], ["Bo %s", "Nobody"], ["Bo %s"]], "canonical": {"J. R. %s": "Julia Ann %s", "Bo %s": ""}, "not_people": %s}',
        *[s] * 8, F.when(s == "McDonald", '["Bo McDonald", "Someone"]').otherwise("[]"),
    )
    return surnames.select("surname", F.when(s == "Machinery", "no object").otherwise(reply).alias("reply"))


_PEOPLE_SQL = """pe AS (SELECT 'entity:person-' || c_custkey AS id, c_custkey, CASE WHEN c_custkey % 11 = 0 THEN 'J. R. R.' WHEN c_custkey % 13 = 0 THEN ['Ann', 'J. R.', 'Bo'][c_custkey % 3 + 1] || ' McDonald'
  ELSE ['Ann', 'J. R.', 'Bo'][c_custkey % 3 + 1] || ' ' || upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) || CASE WHEN c_custkey % 5 = 0 THEN ',' ELSE '' END END AS name FROM customer),
s AS (SELECT *, string_split(name, ' ')[-1] AS surname FROM pe WHERE name <> 'J. R. R.'),
g AS (SELECT * FROM s WHERE length(surname) > 2 AND regexp_matches(surname, '^[A-Z][^A-Z]+$') QUALIFY count(*) OVER (PARTITION BY surname) > 1),
mem AS (SELECT *, CASE WHEN name IN ('Ann ' || surname, 'J. R. ' || surname) THEN 0 WHEN name = 'Bo ' || surname THEN 1 END AS grp FROM g WHERE surname <> 'Machinery'),
grp AS (SELECT *, min(c_custkey) OVER (PARTITION BY surname, grp) AS first, count(*) OVER (PARTITION BY surname, grp) AS n FROM mem WHERE grp IS NOT NULL),
vg AS (SELECT id, 'entity:person-' || first AS canonical, CASE grp WHEN 0 THEN 'Julia Ann ' || surname ELSE CASE WHEN length('Bo ' || surname) >= length('Nobody') THEN 'Bo ' || surname ELSE 'Nobody' END END AS canonical_name FROM grp WHERE n > 1),
rm AS (SELECT id FROM g WHERE name = 'Bo McDonald' UNION SELECT id FROM pe WHERE name = 'J. R. R.'),
pm AS (SELECT id, canonical FROM vg WHERE id <> canonical)"""


def _people_merged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    people = _people(spark, sf_dir)
    groups, not_people = graph.people_verdicts(graph.people_groups(people), _people_replies(spark, sf_dir))
    initials = people.filter(graph.noise.is_initials(F.col("name"))).select("id")
    return graph.apply_groups(people, p.dirty(spark, sf_dir)[1], groups, not_people.union(initials))


@query(f"""WITH {_PEOPLE_SQL} SELECT pe.id, coalesce(canonical_name, name) AS name FROM pe LEFT JOIN vg ON vg.id = pe.id AND vg.canonical = pe.id
WHERE pe.id NOT IN (SELECT id FROM pm) AND pe.id NOT IN (SELECT id FROM rm)""")
def merge_people_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _people_merged(spark, sf_dir)[0].select("id", "name")


@query(f"""WITH {p.DIRTY_SQL.replace("s AS", "s_ AS")}, {_PEOPLE_SQL},
mv AS (SELECT coalesce(a.canonical, subject) AS subject, predicate, coalesce(b.canonical, object) AS object FROM de LEFT JOIN pm a ON a.id = subject LEFT JOIN pm b ON b.id = object
       WHERE subject NOT IN (SELECT id FROM rm) AND object NOT IN (SELECT id FROM rm))
SELECT DISTINCT subject, predicate, object FROM mv WHERE subject <> object""")
def merge_people_apply_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _people_merged(spark, sf_dir)[1].select("subject", "predicate", "object")


# Replies about batches of organizations, whose names repeat: numbers of one last digit are the same.
@query(f"""WITH {p.DIRTY_SQL}, ob AS (SELECT id, 'Org ' || key % 40 AS name, key, (row_number() OVER (ORDER BY key) - 1) // 60 AS batch FROM dn WHERE type = 'Organization'),
ln AS (SELECT batch, name, max(key) AS key FROM ob GROUP BY ALL),
m AS (SELECT ln.*, CASE name WHEN 'Org 7' THEN 0 WHEN 'Org 3' THEN 1 WHEN 'Org 5' THEN 2 END AS pl FROM ln WHERE name IN ('Org 7', 'Org 3', 'Org 5')),
h AS (SELECT batch, arg_min(key, pl) AS first, count(*) AS n FROM m GROUP BY batch),
vg AS (SELECT 'entity:organization-' || key AS id, 'entity:organization-' || first AS canonical FROM m JOIN h USING (batch) WHERE n > 1),
rm AS (SELECT 'entity:organization-' || key AS id FROM ln WHERE name = 'Org 11')
SELECT ob.id, CASE WHEN ob.id IN (SELECT canonical FROM vg) THEN 'Seven' ELSE name END AS name FROM ob WHERE id NOT IN (SELECT id FROM vg WHERE id <> canonical) AND id NOT IN (SELECT id FROM rm)""")
def merge_orgs_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, edges = p.dirty(spark, sf_dir)
    orgs = nodes.filter("type = 'Organization'").withColumn("name", F.concat(F.lit("Org "), F.col("ord.key") % 40))
    batched = graph.batches(orgs.withColumn("all", F.lit(0)), [F.col("ord")], 60, ["all"]).drop("all")
    reply = '{"not_orgs": ["Org 11", "Org 99"], "merge_groups": [["Org 7", "Org 3", "Org 5"], ["Org 8"], ["Org 9", "Org 99"]], "canonical": {"Org 7": "Seven"}}'
    groups, removed = graph.org_verdicts(batched.select("batch", "id", "name", "ord"), batched.select("batch").distinct().withColumn("reply", F.lit(reply)))
    return graph.apply_groups(orgs, edges, groups, removed)[0].select("id", "name")


# Fragments: an order is a source; its title names one of its lines' brands, or nothing in it.
def _fragment(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    # Sources, entities, topics and relationships all come from these rows: they are joined once.
    rows = scratch.materialise(p.base(spark, sf_dir), scratch.new_folder(spark, "fragments"), "rows")
    title = F.when(F.col("ok") % 3 == 0, F.concat(F.lit("Wikipedia: "), F.lower("work"))).when(F.col("ok") % 3 == 1, F.concat(F.lit("A note on "), "place", F.lit(" and others"))).otherwise(F.concat(F.lit("PEAR: 1995 - Report "), F.col("ok").cast("string")))
    sources = rows.groupBy("source").agg(F.min(F.struct(*p.KEYS, title.alias("title")))["title"].alias("title"))
    kinds = [("work", "WORK_OF_ART"), ("place", "GPE"), ("organization", "ORG")]
    items = [F.struct(F.col(f"{c}_id").alias("id"), F.lit(label).alias("label"), F.col(c).alias("name"), F.lit(i).alias("pos")) for i, (c, label) in enumerate(kinds)]
    entities = rows.select("source", *p.KEYS, F.explode(F.array(*items)).alias("e")).groupBy("source", "e.id", "e.label", "e.name").agg(F.min(F.struct(*p.KEYS, "e.pos")).alias("ord"))
    # Orders of even numbers relate an organization with a work, those of odd numbers a place with itself.
    even = F.col("ok") % 2 == 0
    subject = F.when(even, F.col("organization_id")).otherwise(F.col("place_id"))
    object_ = F.when(even, F.col("work_id")).otherwise(F.col("place_id"))
    extracted = rows.select("source", subject.alias("subject"), F.lit("part_of").alias("predicate"), object_.alias("object"), "confidence", "extracted_by")
    return sources, entities, extracted


_FRAGMENT_SQL = f"""{p.BASE_SQL},
fb AS MATERIALIZED (SELECT *, 'entity:creativework-' || {p.slug_sql("work")} AS work_id, 'entity:place-' || {p.slug_sql("place")} AS place_id, 'entity:organization-' || {p.slug_sql("organization")} AS organization_id FROM base),
src AS MATERIALIZED (SELECT source, arg_min(CASE ok % 3 WHEN 0 THEN 'Wikipedia: ' || lower(work) WHEN 1 THEN 'A note on ' || place || ' and others' ELSE 'PEAR: 1995 - Report ' || ok END, (ok, ln, pk, sk, ep)) AS title
        FROM fb GROUP BY source),
ent AS MATERIALIZED (SELECT source, id, type, name, min(o) AS o FROM (
  SELECT source, work_id AS id, 'CreativeWork' AS type, work AS name, (ok, ln, pk, sk, ep, 0) AS o FROM fb
  UNION ALL SELECT source, place_id, 'Place', place, (ok, ln, pk, sk, ep, 1) FROM fb
  UNION ALL SELECT source, organization_id, 'Organization', organization, (ok, ln, pk, sk, ep, 2) FROM fb) GROUP BY source, id, type, name),
ext AS MATERIALIZED (SELECT source, CASE WHEN ok % 2 = 0 THEN organization_id ELSE place_id END AS subject, 'woo:partOf' AS predicate, CASE WHEN ok % 2 = 0 THEN work_id ELSE place_id END AS object, confidence, extracted_by FROM fb),
w AS (SELECT source, title, lower(trim(regexp_replace(title, '^Wikipedia:', ''))) AS wanted FROM src),
hit AS MATERIALIZED (SELECT ent.source AS source, arg_min({{'id': id, 'name': name}}, (lower(name) <> wanted, CASE WHEN lower(name) <> wanted THEN -length(name) ELSE 0 END, o, id, name)) AS best FROM ent JOIN w ON w.source = ent.source
        WHERE contains(wanted, lower(name)) OR contains(lower(name), wanted) GROUP BY ent.source),
made AS (SELECT src.source AS source, trim(regexp_replace(trim(regexp_replace(title, '^(PEAR|Wikipedia):', '')), '^[0-9]{{4}}[-\\s]+', '')) AS topic FROM src ANTI JOIN hit ON hit.source = src.source),
topic AS MATERIALIZED (SELECT source, best.id AS id, best.name AS name, false AS synthetic FROM hit UNION ALL SELECT source, 'entity:event-' || {p.slug_sql("topic")}, topic, true FROM made),
linked AS (SELECT source, subject AS id FROM ext UNION SELECT source, object FROM ext)"""


@query(f"WITH {_FRAGMENT_SQL} SELECT * FROM topic")
def topic_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources, entities, _ = _fragment(spark, sf_dir)
    return graph.topics(sources, entities)


@query(f"""WITH {_FRAGMENT_SQL}
SELECT source, source AS id, 'woo:Source' AS type, title AS name FROM src UNION ALL SELECT source, id, type, name FROM ent UNION ALL SELECT source, id, 'Event', name FROM topic WHERE synthetic""")
def fragment_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources, entities, _ = _fragment(spark, sf_dir)
    return graph.fragment_nodes(sources, entities, graph.topics(sources, entities))


@query(f"""WITH {_FRAGMENT_SQL}
SELECT source, id AS subject, 'woo:mentionedIn' AS predicate, source AS object, 1.0::DOUBLE AS confidence, 'pipeline' AS extracted_by FROM ent
UNION ALL SELECT source, id, 'woo:mentionedIn', source, 1.0, 'pipeline' FROM topic WHERE synthetic
UNION ALL SELECT source, subject, predicate, object, confidence, extracted_by FROM ext
UNION ALL SELECT ent.source, ent.id, 'woo:relatedTo', topic.id, 0.3, 'pipeline' FROM ent ANTI JOIN linked ON linked.source = ent.source AND linked.id = ent.id JOIN topic ON topic.source = ent.source AND topic.id <> ent.id""")
def fragment_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources, entities, extracted = _fragment(spark, sf_dir)
    folder = scratch.new_folder(spark, "fragments")
    # Both are looked at several times.
    entities = scratch.materialise(entities, folder, "entities")
    topic = scratch.materialise(graph.topics(sources, entities), folder, "topics")
    return graph.fragment_edges(entities, extracted, topic)


@query(f"WITH {p.BASE_SQL}{p.MERGED_EDGES_SQL} SELECT subject, predicate, object, confidence, extracted_by, n_sources, first_source FROM me")
def stream_incremental_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges merged by a stream over files of fragments, equal to the batch's."""
    folder = scratch.new_folder(spark, "stream")
    _, _, edges = p.graph(spark, sf_dir)
    edges.write.parquet(f"{folder}/arriving")
    # Few files a batch, so that several batches have to fold into one result.
    arriving = spark.readStream.schema(edges.schema).option("maxFilesPerTrigger", 4).parquet(f"{folder}/arriving")
    incremental.stream_edges(arriving, f"{folder}/state", f"{folder}/checkpoint").awaitTermination()
    return incremental.merged_so_far(spark, f"{folder}/state").drop("ord")
