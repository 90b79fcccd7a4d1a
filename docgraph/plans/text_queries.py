"""Queries on names, texts, pages, replies and manifests."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docgraph.functions import markup, names, noise
from docgraph.operators import graph, process, resolve
from docgraph.plans import projections as p
from docgraph.plans.registering import Query, filing
from docgraph.sources import manifests, publish

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
query = filing(QUERIES, ORACLES)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.table(spark, sf_dir, "documents")


# --- names -----------------------------------------------------------------------


@query(f"SELECT doc_id, {p.slug_sql('text')} AS slug FROM documents")
def slug_ascii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", names.slug(F.col("text")).alias("slug"))


# Letters of the Latin blocks by their decompositions, whose marks are separators like all else.
_NFKD_SQL = "text"
for _c in map(chr, range(0xA0, 0x180)):
    if (_apart := unicodedata.normalize("NFKD", _c)) != _c:
        _NFKD_SQL = f"replace({_NFKD_SQL}, '{_c}', '{_apart}')"


@query(f"SELECT doc_id, {p.slug_sql(_NFKD_SQL)} AS slug FROM documents")
def slug_nfkd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", names.slug_nfkd(F.col("text")).alias("slug"))


_LABELS = ["PERSON", "ORG", "GPE", "LOC", "FAC", "DATE", "EVENT", "WORK_OF_ART", "MONEY"]


def _label(key: str) -> Column:
    return F.element_at(F.array(*map(F.lit, _LABELS)), (F.col(key) % 9 + 1).cast("int"))


_LABEL_SQL = f"{_LABELS}[p_partkey % 9 + 1]"


@query(f"""SELECT p_partkey, 'entity:' || CASE {_LABEL_SQL} WHEN 'ORG' THEN 'organization' WHEN 'GPE' THEN 'place' WHEN 'LOC' THEN 'place' WHEN 'FAC' THEN 'place' WHEN 'WORK_OF_ART' THEN 'creativework'
  ELSE lower({_LABEL_SQL}) END || '-' || {p.slug_sql("p_name")} AS id FROM part""")
def entity_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.table(spark, sf_dir, "part").select("p_partkey", names.entity_id(_label("p_partkey"), names.slug(F.col("p_name"))).alias("id"))


@query(f"""SELECT p_partkey, CASE {_LABEL_SQL} WHEN 'PERSON' THEN 'Person' WHEN 'ORG' THEN 'Organization' WHEN 'GPE' THEN 'Place' WHEN 'LOC' THEN 'Place' WHEN 'FAC' THEN 'Place'
  WHEN 'DATE' THEN 'Date' WHEN 'EVENT' THEN 'Event' WHEN 'WORK_OF_ART' THEN 'CreativeWork' ELSE 'Thing' END AS type FROM part""")
def schema_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.table(spark, sf_dir, "part").select("p_partkey", names.schema_type(_label("p_partkey")).alias("type"))


@query("""SELECT p_partkey, string_split(s, '_')[1] || array_to_string(list_transform(string_split(s, '_')[2:], lambda x: upper(x[1]) || lower(x[2:])), '') AS name
FROM (SELECT p_partkey, replace(p_name, ' ', '_') || '_' || p_type AS s FROM part)""")
def camel_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    snake = F.concat(F.replace(F.col("p_name"), F.lit(" "), F.lit("_")), F.lit("_"), "p_type")
    return p.table(spark, sf_dir, "part").select("p_partkey", names.camel_case(snake).alias("name"))


@query("""SELECT p_partkey, lower(regexp_replace(CASE p_partkey % 3 WHEN 0 THEN 'locatedIn' || p_type WHEN 1 THEN 'someName' || p_type ELSE 'plainTerm' END, '([a-z])([A-Z])', '\\1 \\2', 'g')) AS label FROM part""")
def clean_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey") % 3
    raw = F.when(k == 0, F.concat(F.lit("woo:locatedIn"), "p_type")).when(k == 1, F.concat(F.lit("https://host/terms/someName"), "p_type")).otherwise(F.lit("plainTerm"))
    return p.table(spark, sf_dir, "part").select("p_partkey", names.clean_predicate(raw).alias("label"))


@query("SELECT conv_id, turn, sha256(role || chr(10) || '---' || chr(10) || text) AS key FROM conversations")
def cache_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.table(spark, sf_dir, "conversations").select("conv_id", "turn", names.cache_key(F.col("role"), F.col("text")).alias("key"))


@query("""WITH RECURSIVE h(id, i, v) AS (SELECT p_partkey, 0, 0::HUGEINT FROM part UNION ALL
  SELECT id, i + 1, (v * 31 + unicode(p_name[i + 1])) % 4294967296 FROM h JOIN part ON p_partkey = id WHERE i < length(p_name))
SELECT id, CAST(CASE WHEN v >= 2147483648 THEN v - 4294967296 ELSE v END AS BIGINT) AS hash FROM h JOIN part ON p_partkey = id WHERE i = length(p_name)""")
def rolling_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), names.rolling_hash(F.col("p_name")).alias("hash"))


@query("""SELECT c_custkey, round((CASE WHEN c_custkey % 2 = 0 THEN -1 ELSE 1 END) * (c_custkey % 90 + (c_custkey % 60)::DOUBLE / 60 + (c_custkey % 59)::DOUBLE / 3600), 6) + 0.0 AS degrees FROM customer""")
def gps_degrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    degrees = names.dms_to_degrees(k % 90, k % 60, k % 59, F.when(k % 2 == 0, "S").otherwise("N"))
    return p.table(spark, sf_dir, "customer").select("c_custkey", F.round(degrees, 6).alias("degrees"))


# --- noise -----------------------------------------------------------------------

# Names of many kinds made from parts: numbers, citations, tables, markup, dates, plain names.
_STYLES = [
    ("p_name", "p_name"),
    ("p_partkey || ', 72^Ref'", "concat(p_partkey, ', 72^Ref')"),
    ("'[' || p_partkey || ']'", "concat('[', p_partkey, ']')"),
    ("'p. ' || p_partkey", "concat('p. ', p_partkey)"),
    ("p_partkey || '-' || p_size", "concat(p_partkey, '-', p_size)"),
    ("'TX'", "'TX'"),
    ("'Table ' || p_size", "concat('Table ', p_size)"),
    ("'|' || p_size || '|x|'", "concat('|', p_size, '|x|')"),
    ("'late 19' || (p_size + 40) || ' talks'", "concat('late 19', p_size + 40, ' talks')"),
    ("upper(p_name[1]) || p_name[2:] || ','", "concat(upper(substr(p_name, 1, 1)), substr(p_name, 2), ',')"),
    ("'methods'", "'methods'"),
    ("'Einstein-Podolski ' || p_size", "concat('Einstein-Podolski ', p_size)"),
    ("'Grand ' || upper(p_type[1]) || lower(p_type[2:]) || ' Hall'", "concat('Grand ', initcap(p_type), ' Hall')"),
    ("'March ' || (p_size % 28 + 1) || ', 19' || (p_size + 40)", "concat('March ', p_size % 28 + 1, ', 19', p_size + 40)"),
    ("'x$' || p_size || '{}'", "concat('x$', p_size, '{}')"),
    ("'a  b ' || p_name", "concat('a  b ', p_name)"),
]
_NAMES_SQL = "nm AS (SELECT p_partkey, CASE p_partkey % 16 " + " ".join(f"WHEN {i} THEN {sql}" for i, (sql, _) in enumerate(_STYLES)) + f" END AS name, {_LABEL_SQL} AS label FROM part)"


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.expr("CASE p_partkey % 16 " + " ".join(f"WHEN {i} THEN {sql}" for i, (_, sql) in enumerate(_STYLES)) + " END")
    return p.table(spark, sf_dir, "part").select("p_partkey", name.alias("name"), _label("p_partkey").alias("label"))


_REFERENCE_SQL = " OR ".join(f"regexp_matches(name, '{x}')" for x in noise.REFERENCE_PATTERNS)
_WORDS_SQL = "(" + ", ".join(f"'{w}'" for w in noise.COMMON_WORDS) + ")"
_RATIO_SQL = "length(regexp_replace({0}, '[^\\p{{L}}\\s]', '', 'g')) / greatest(length({0}), 1)"


@query(f"WITH {_NAMES_SQL} SELECT p_partkey, name, {_REFERENCE_SQL} AS is_reference FROM nm")
def reference_noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _names(spark, sf_dir).withColumn("is_reference", noise.is_reference(F.col("name"))).drop("label")


@query(f"SELECT doc_id, round({_RATIO_SQL.format('text')}, 9) AS ratio FROM documents")
def alpha_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", F.round(noise.alpha_ratio(F.col("text")), 9).alias("ratio"))


@query(f"""WITH {_NAMES_SQL} SELECT p_partkey, CASE WHEN label = 'DATE' AND regexp_extract(name, '{noise.EXPLICIT_DATE}', 1) <> '' THEN regexp_extract(name, '{noise.EXPLICIT_DATE}', 1) ELSE trim(name) END AS name, label
FROM nm WHERE label <> 'MONEY' AND length(name) > 3 AND NOT ({_REFERENCE_SQL}) AND lower(name) NOT IN {_WORDS_SQL} AND {_RATIO_SQL.format("name")} >= 0.5
  AND (label <> 'DATE' OR regexp_matches(name, '{noise.YEAR_1500_2029}'))""")
def mention_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, label = F.col("name"), F.col("label")
    return _names(spark, sf_dir).filter(noise.is_entity_mention(name, label)).select("p_partkey", noise.mention_name(name, label).alias("name"), "label")


@query(f"""WITH {_NAMES_SQL}, o AS (SELECT name, label, p_partkey AS start, row_number() OVER (PARTITION BY name, label ORDER BY p_partkey) - 1 AS n FROM nm)
SELECT name, label, CAST(n // 100 AS BIGINT) AS part, count(*) AS mention_count, min(start) AS first_start, md5(string_agg(start::TEXT, ',' ORDER BY start)) AS spans FROM o GROUP BY name, label, part""")
def mention_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions of a name under a label, with their places in order (as a digest), in parts of a hundred."""
    rows = graph.batches(_names(spark, sf_dir), [F.col("p_partkey")], 100, ["name", "label"])
    spans = F.array_sort(F.collect_list("p_partkey"))
    return rows.groupBy("name", "label", F.col("batch").alias("part")).agg(F.count("*").alias("mention_count"), F.min("p_partkey").alias("first_start"), F.md5(F.array_join(spans.cast("array<string>"), ",")).alias("spans"))


@query(f"""WITH {_NAMES_SQL} SELECT p_partkey, name, length(name) >= 3 AND lower(name) NOT IN ({", ".join(f"'{w}'" for w in noise.NON_PLACES)})
  AND NOT ({" OR ".join(f"regexp_matches(name, '{x}')" for x in noise.PLACE_NOISE_PATTERNS if "(?!" not in x)})
  AND NOT (regexp_matches(name, '^[a-z]') AND NOT regexp_matches(name, '^[a-z]he\\s')) AND regexp_matches(name, '\\p{{L}}') AS geocodable FROM nm""")
def geocodable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _names(spark, sf_dir).withColumn("geocodable", noise.is_geocodable(F.col("name"))).drop("label")


@query(f"""WITH {_NAMES_SQL} SELECT p_partkey, name FROM nm WHERE length(name) <= 5 OR name[-1] IN ('.', ',', ';', ':', '!', '?', ')') OR regexp_matches(name, '^[A-Z][A-Z.]+$')
  OR (regexp_matches(name, '[0-9]') AND regexp_matches(name, '[a-zA-Z]') AND length(name) < 15)""")
def suspicious_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _names(spark, sf_dir).filter(noise.is_suspicious(F.col("name"))).drop("label")


# --- text ------------------------------------------------------------------------


@query(r"""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '\*{1,3}([^*]+)\*{1,3}', '\1', 'g'), '_{1,3}([^_]+)_{1,3}', '\1', 'g'),
  '(?m)^#{1,6}\s+', '', 'g'), '\[([^\]]+)\]\([^)]+\)', '\1', 'g'), '!\[([^\]]*)\]\([^)]+\)', '\1', 'g'), '`([^`]+)`', '\1', 'g') AS plain FROM documents""")
def strip_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", markup.strip_markdown(F.col("text")).alias("plain"))


_BLANK_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


@query(f"""WITH s AS (SELECT doc_id, text, length(text) // 2 AS a FROM documents), t AS (SELECT *, greatest(0, a - 100) AS low, least(length(text), a + 10 + 100) AS high FROM s)
SELECT doc_id, CASE WHEN low > 0 THEN '...' ELSE '' END || trim(substr(text, low + 1, high - low), {_BLANK_SQL}) || CASE WHEN high < length(text) THEN '...' ELSE '' END AS snippet FROM t""")
def context_snippet(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.floor(F.length("text") / 2).cast("int")
    return _documents(spark, sf_dir).select("doc_id", markup.context_snippet(F.col("text"), start, start + 10).alias("snippet"))


_CHUNKS_SQL = """c(doc_id, text, pos, start, stop) AS (
  SELECT doc_id, text, -1, 0, 0 FROM documents
  UNION ALL
  SELECT doc_id, text, pos + 1, stop, CASE WHEN length(text) - stop <= 2000 THEN length(text) WHEN dot > 1000 THEN stop + dot + 1 ELSE stop + 2000 END FROM (
    SELECT *, 2000 - instr(reverse(substr(text, stop + 1, 2000)), '.') + CASE WHEN contains(substr(text, stop + 1, 2000), '.') THEN 0 ELSE -9999 END AS dot FROM c WHERE stop < length(text) OR pos = -1) WHERE pos = -1 OR stop < length(text))"""


@query(f"WITH RECURSIVE {_CHUNKS_SQL} SELECT doc_id, pos, substr(text, start + 1, stop - start) AS chunk FROM c WHERE pos >= 0")
def chunk_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", F.posexplode(markup.chunks(F.col("text"))).alias("pos", "chunk")).withColumn("pos", F.col("pos").cast("int"))


@query(f"""WITH RECURSIVE {_CHUNKS_SQL}, ch AS (SELECT doc_id, pos, lower(substr(text, start + 1, stop - start)) AS chunk FROM c WHERE pos >= 0),
en AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(text, '[A-Z][a-z]{{4,}}'))) AS name FROM documents)
SELECT ch.doc_id, pos, count(*) AS entities FROM ch JOIN en ON en.doc_id = ch.doc_id AND contains(chunk, lower(name)) GROUP BY ch.doc_id, pos HAVING count(*) >= 2""")
def chunk_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks that contain two or more of their document's entities (its capitalised words)."""
    d = _documents(spark, sf_dir).select(F.col("doc_id").alias("source"), "text")
    entities = d.select("source", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit("[A-Z][a-z]{4,}"), F.lit(0)))).alias("name"))
    found = process.chunks_with_entities(d, entities)
    return found.select(F.col("source").alias("doc_id"), F.col("pos").cast("int").alias("pos"), F.size("names").cast("long").alias("entities"))


# --- replies -----------------------------------------------------------------------

_REPLY_SQL = """rp AS (SELECT o_orderkey AS source, CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'no json' WHEN 2 THEN '{"subject": "x"}'
  ELSE '[{"subject": "S' || o_custkey || '", "predicate": "member_of", "object": "O' || o_orderkey % 7 || '", "confidence": 0.9}, {"subject": "S1", "predicate": "flies_to", "object": "O1", "confidence": 1.0}, {"subject": "s' || o_custkey || '", "predicate": "founded", "object": "nobody"}]' END AS reply FROM orders)"""


def _replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    rows = F.format_string(
        '[{"subject": "S%d", "predicate": "member_of", "object": "O%d", "confidence": 0.9}, {"subject": "S1", "predicate": "flies_to", "object": "O1", "confidence": 1.0}, {"subject": "s%d", "predicate": "founded", "object": "nobody"}]',
        F.col("o_custkey"), k % 7, F.col("o_custkey"),
    )
    reply = F.when(k % 5 == 0, F.lit(None)).when(k % 5 == 1, "no json").when(k % 5 == 2, '{"subject": "x"}').otherwise(rows)
    return p.table(spark, sf_dir, "orders").select(k.alias("source"), reply.alias("reply"))


def _reply_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replies(spark, sf_dir).select("source", F.explode(markup.reply_rows(F.col("reply"))).alias("r")).select("source", "r.*")


@query(f"""WITH {_REPLY_SQL}, x AS (SELECT source, unnest(from_json(reply, '[{{"subject": "VARCHAR", "predicate": "VARCHAR", "object": "VARCHAR", "confidence": "DOUBLE"}}]')) AS r FROM rp WHERE source % 5 > 2)
SELECT source, r.subject AS subject, r.predicate AS predicate, r.object AS object, coalesce(r.confidence, 0) AS confidence FROM x WHERE r.predicate <> 'flies_to'""")
def parse_reply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reply_rows(spark, sf_dir)


@query("""SELECT o_orderkey AS source, 'id-S' AS subject, 'member_of' AS predicate, 'id-O' || o_orderkey % 7 AS object, 0.9::DOUBLE AS confidence FROM orders WHERE o_orderkey % 5 > 2 AND o_orderkey % 7 < 5""")
def reply_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reply rows whose names are entities of their source, by id."""
    o = p.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("source"), "o_custkey")
    subjects = o.select("source", F.lit("id-S").alias("id"), F.concat(F.lit("S"), "o_custkey").alias("name"), F.lit(0).alias("ord"))
    objects = o.select("source", F.posexplode(F.array(*(F.lit(f"o{i}") for i in range(5)))).alias("ord", "name")).select("source", F.concat(F.lit("id-O"), "ord").alias("id"), "name", "ord")
    entities = subjects.union(objects)
    return resolve.relationship_ids(_reply_rows(spark, sf_dir), entities).select("source", "subject", "predicate", "object", "confidence")


# --- links -------------------------------------------------------------------------


def _links(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = p.table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return pages.select("page_id", F.col("url").alias("base"), F.posexplode(markup.page_links(F.col("html"), F.col("url"))).alias("pos", "link")).select("page_id", "base", "pos", "link.url", "link.title")


# The pages write their links in one form, with paths from the root or whole addresses.
@query(f"""WITH a AS (SELECT page_id, url, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host, regexp_extract(url, '^[a-z]+:') AS scheme,
  unnest(regexp_extract_all(html, '<a href="([^"]*)">[^<]*</a>', 1)) AS href, unnest(regexp_extract_all(html, '<a href="[^"]*">([^<]*)</a>', 1)) AS text, generate_subscripts(regexp_extract_all(html, '<a href="([^"]*)">[^<]*</a>'), 1) AS i FROM pages),
b AS (SELECT page_id, url, host, i, text, regexp_replace(CASE WHEN regexp_matches(href, '^[a-z]+:') THEN href WHEN href[:2] = '//' THEN scheme || href ELSE scheme || '//' || host || href END, '#.*$', '') AS link FROM a WHERE href <> ''),
f AS (SELECT page_id, host, link, min(i) AS i, arg_min(trim(text), i) AS text FROM b WHERE link <> url GROUP BY page_id, host, link),
n AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS pos FROM f)
SELECT page_id, CAST(pos AS INT) AS pos, link AS url, CASE WHEN text = '' THEN link ELSE text END AS title FROM n
WHERE regexp_extract(link, '^([a-z]+)://', 1) IN ('http', 'https') AND regexp_extract(link, '^[a-z]+://([^/?#]*)', 1) = host
  AND NOT ({" OR ".join(f"contains(lower(regexp_extract(link, '^[a-z]+://[^/?#]*([^?#]*)', 1)), '{x}')" for x in markup.SKIPPED_PATHS)})""")
def discover_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of each page to pages with content on its host."""
    host = F.try_parse_url("base", F.lit("AUTHORITY"))
    return _links(spark, sf_dir).filter(markup.is_content_url(F.col("url"), host)).select("page_id", F.col("pos").cast("int").alias("pos"), "url", "title")


_ORIGIN_SQL = "regexp_extract(url, '^[a-z]+://[^/?#]*')"


@query(f"""SELECT page_id, CASE page_id % 5 WHEN 0 THEN {_ORIGIN_SQL} || '/p/2' WHEN 1 THEN regexp_extract(url, '^[^?#]*') || '?page=2' WHEN 2 THEN {_ORIGIN_SQL} || '/more'
  WHEN 3 THEN 'https://elsewhere.example/' || page_id END AS next FROM pages""")
def next_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with four kinds of links to a next page added, and with none."""
    k = F.col("page_id") % 5
    added = F.when(k == 0, '<link rel="next" href="/p/2">').when(k == 1, '<a rel="prev next" href="?page=2">on</a>').when(k == 2, '<a href="/more"> Next </a>')
    added = added.when(k == 3, F.concat(F.lit('<a href="https://elsewhere.example/'), "page_id", F.lit('">»</a>'))).otherwise("")
    return p.table(spark, sf_dir, "pages").select("page_id", markup.next_page(F.concat("html", added), F.col("url")).alias("next"))


_URL_SQL = "u AS (SELECT page_id, regexp_extract(url, '^([a-z]+)://', 1) AS scheme, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host, lower(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1)) AS path FROM pages)"


@query(f"""WITH {_URL_SQL} SELECT page_id, scheme IN ('http', 'https') AND NOT ({" OR ".join(f"contains(path, '{x}')" for x in markup.SKIPPED_PATHS)}) AS is_content FROM u""")
def content_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.table(spark, sf_dir, "pages").select("page_id", markup.is_content_url(F.col("url"), F.try_parse_url("url", F.lit("AUTHORITY"))).alias("is_content"))


# --- manifests -----------------------------------------------------------------------


def _submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as submissions of all kinds, with and without their faults."""
    k = F.col("page_id")
    kind = F.element_at(F.array(*map(F.lit, ["pdf", "url", "account", "video", "index"])), (k % 5 + 1).cast("int"))
    source = F.struct(
        F.when(k % 7 > 0, F.when(k % 11 == 0, "").otherwise(F.concat(F.lit("Page "), k))).alias("title"),
        kind.alias("type"),
        F.when(k % 3 > 0, F.when(k % 2 == 0, F.concat("url", F.lit("/clip.MP4?x=1#y"))).otherwise(F.col("url"))).alias("url"),
        F.when(k % 4 == 0, "a.pdf").alias("file"),
        F.lit("2024-01-01").alias("date_added"),
    )
    return p.table(spark, sf_dir, "pages").select(F.concat(F.lit("s-"), k).alias("slug"), "page_id", source.alias("source"))


_SUBMISSION_SQL = """sb AS (SELECT page_id, CASE WHEN page_id % 7 > 0 THEN CASE WHEN page_id % 11 = 0 THEN '' ELSE 'Page ' || page_id END END AS title, ['pdf', 'url', 'account', 'video', 'index'][page_id % 5 + 1] AS type,
  CASE WHEN page_id % 3 > 0 THEN CASE WHEN page_id % 2 = 0 THEN url || '/clip.MP4?x=1#y' ELSE url END END AS url, CASE WHEN page_id % 4 = 0 THEN 'a.pdf' END AS file FROM pages)"""


@query(f"""WITH {_SUBMISSION_SQL} SELECT page_id, CASE WHEN type = 'url' AND url IS NOT NULL AND regexp_matches(regexp_replace(url, '[?#].*', ''), '\\.(mov|mp4|m4v|avi|webm|mkv|mpg|mpeg|wmv|flv)$', 'i') THEN 'video' ELSE type END AS kind FROM sb""")
def route_submission(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifests.routed(_submissions(spark, sf_dir)).select("page_id", "kind")


@query(f"""WITH {_SUBMISSION_SQL}, f AS (SELECT *, list_filter([CASE WHEN title IS NULL THEN 'source: ''title'' is a required property' END, CASE WHEN title = '' THEN 'source.title: '''' should be non-empty' END,
  CASE WHEN type = 'index' THEN 'source.type: ''index'' is not one of [''pdf'', ''url'', ''account'', ''video'']' END, CASE WHEN type = 'url' AND url IS NULL THEN 'source: ''url'' is a required property' END,
  CASE WHEN type IN ('pdf', 'video') AND file IS NULL AND url IS NULL THEN 'source: is not valid under any of the given schemas' END], lambda x: x IS NOT NULL) AS form FROM sb),
m AS (SELECT *, list_filter([CASE WHEN type = 'pdf' AND file IS NOT NULL AND page_id % 8 > 0 THEN 'PDF file not found: ' || file END, CASE WHEN type = 'video' AND url IS NULL THEN 'video type requires ''url'' field' END,
  CASE WHEN type = 'account' AND page_id % 9 > 0 THEN 'Account type requires companion markdown file' END], lambda x: x IS NOT NULL) AS meaning FROM f)
SELECT page_id, array_to_string(CASE WHEN len(form) > 0 THEN form ELSE meaning END, '; ') AS problems FROM m""")
def validate_submission(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = manifests.problems(F.col("source"), F.col("page_id") % 8 == 0, F.col("page_id") % 9 == 0)
    return _submissions(spark, sf_dir).select("page_id", F.array_join(found, "; ").alias("problems"))


@query("SELECT 's-' || page_id AS slug FROM pages WHERE page_id % 3 > 0")
def new_submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    subs = _submissions(spark, sf_dir)
    return manifests.pending(subs, subs.filter("page_id % 3 = 0")).select("slug")


@query("SELECT 's-' || page_id AS slug, CASE WHEN page_id % 2 = 0 THEN 'first' ELSE 'second' END AS root FROM pages")
def metadata_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    subs = _submissions(spark, sf_dir)
    return manifests.metadata_with_precedence(subs.filter("page_id % 2 = 0").select("slug", F.lit("first").alias("root")), subs.select("slug", F.lit("second").alias("root")))


@query("SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN length(text) END AS value FROM conversations")
def cache_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests joined with a cache that knows every other turn, by the hash of (conversation, turn, text)."""
    turns = p.table(spark, sf_dir, "conversations").select("conv_id", "turn", "text", F.col("conv_id").cast("string").alias("a"), F.col("turn").cast("string").alias("b"))
    cache = turns.filter("turn % 2 = 0").select(names.cache_key(F.col("a"), F.col("b"), F.col("text")).alias("key"), F.length("text").cast("long").alias("value")).distinct()
    return manifests.cached(turns, cache, "a", "b", "text").select("conv_id", "turn", "value")


@query("""SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'none' WHEN 1 THEN 'miss' WHEN 2 THEN 'hit' WHEN 3 THEN 'corrupt' ELSE 'none' END AS state FROM events""")
def geocache_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id") % 5
    entry = F.when(e == 1, "null").when(e == 2, F.col("props")).when(e == 3, "[1]").when(e == 4, "{broken")
    return p.table(spark, sf_dir, "events").select("event_id", manifests.lookup_state(entry).alias("state"))


# --- media, serving, publishing ---------------------------------------------------------


@query("""WITH f AS (SELECT p_partkey // 10 AS slug, p_partkey % 2 AS root, CASE WHEN p_partkey % 9 = 0 THEN 'best_frame.png' WHEN p_partkey % 4 = 0 THEN 'z' || p_partkey || '.mp4' ELSE 'f' || p_partkey || '.png' END AS name FROM part)
SELECT slug, arg_min(name, (root, name <> 'best_frame.png', name)) AS thumbnail FROM f WHERE name LIKE '%.png' GROUP BY slug""")
def thumbnails(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    name = F.when(k % 9 == 0, "best_frame.png").when(k % 4 == 0, F.concat(F.lit("z"), k, F.lit(".mp4"))).otherwise(F.concat(F.lit("f"), k, F.lit(".png")))
    return publish.thumbnails(p.table(spark, sf_dir, "part").select(F.floor(k / 10).alias("slug"), (k % 2).alias("root"), name.alias("name")))


@query("""WITH f AS (SELECT p_partkey AS slug, unnest(['debug_detections', 'track2_debug_detections', 'track' || p_size || '_stack', 'stack']) AS key FROM part)
SELECT slug, CASE WHEN key = 'debug_detections' THEN 0 WHEN key LIKE 'track%' THEN regexp_extract(key, '^track([0-9]+)_', 1)::INT ELSE 1 END AS object, regexp_replace(key, '^track[0-9]+_', '') AS base, key, key || '.png' AS filename FROM f""")
def output_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = F.array(F.lit("debug_detections"), F.lit("track2_debug_detections"), F.concat(F.lit("track"), "p_size", F.lit("_stack")), F.lit("stack"))
    outputs = F.map_from_entries(F.transform(keys, lambda k: F.struct(k, F.concat(k, F.lit(".png")))))
    return publish.output_files(p.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("slug"), outputs.alias("outputs")))


@query("""SELECT page_id, CASE WHEN page_id % 11 = 0 THEN 400 WHEN strlen(html) > 2000 THEN 413 ELSE 200 END AS upload, CASE WHEN page_id % 3 = 0 OR page_id % 4 = 0 THEN 400 ELSE 200 END AS submit FROM pages""")
def guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id")
    size = F.when(k % 11 > 0, F.octet_length("html"))
    submit = publish.submit_status(F.when(k % 3 > 0, "T").otherwise(""), F.when(k % 4 > 0, "url"))
    return p.table(spark, sf_dir, "pages").select("page_id", publish.upload_status(size, 2000).alias("upload"), submit.alias("submit"))


@query("""WITH r AS (SELECT page_id, encode(html) AS b, strlen(html) AS n, page_id % 5 * 700 AS a, CASE WHEN page_id % 2 = 0 THEN page_id % 5 * 700 + 99 END AS z FROM pages),
e AS (SELECT *, least(coalesce(z, n - 1), n - 1) AS last FROM r)
SELECT page_id, CASE WHEN page_id % 7 = 0 THEN 200 ELSE 206 END AS status, CASE WHEN page_id % 7 = 0 THEN n ELSE greatest(last - a + 1, 0) END AS n_bytes,
  CASE WHEN page_id % 7 > 0 THEN 'bytes ' || a || '-' || last || '/' || n END AS content_range FROM e""")
def byte_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id")
    begin = k % 5 * 700
    header = F.when(k % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit("bytes="), begin, F.lit("-"), F.when(k % 2 == 0, (begin + 99).cast("string")).otherwise("")))
    found = p.table(spark, sf_dir, "pages").select("page_id", publish.byte_range(F.encode("html", "utf-8"), header).alias("r"))
    return found.select("page_id", "r.status", F.octet_length("r.body").cast("long").alias("n_bytes"), "r.content_range")


@query("""SELECT c_custkey, 'entity__place_' || c_custkey || '__' || c_mktsegment || '.json' AS file FROM customer""")
def cache_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.table(spark, sf_dir, "customer").select("c_custkey", names.cache_file(F.concat(F.lit("entity:/place_"), "c_custkey", F.lit("/:"), "c_mktsegment")).alias("file"))


@query("""SELECT 's-' || page_id AS slug, '{"source_slug":"s-' || page_id || '","title":"T' || page_id || '","type":"' || ['pdf', 'url', 'account', 'video', 'index'][page_id % 5 + 1] || '","author":"' || CASE WHEN page_id % 2 = 0 THEN 'A' ELSE '' END ||
  '","date_added":"2024-01-01","tags":[],"description":"","content_file":"content.md","processed_at":"now"}' AS json FROM pages""")
def source_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id")
    own = _submissions(spark, sf_dir).select("slug", F.concat(F.lit("T"), k).alias("title"), "source.type", F.when(k % 2 == 0, "A").alias("author"), "source.date_added", F.lit(None).cast("array<string>").alias("tags"), F.lit(None).cast("string").alias("description"))
    return publish.source_metadata(own, "now")
