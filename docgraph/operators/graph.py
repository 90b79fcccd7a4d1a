"""Building, merging and cleaning the graph.

Tables: nodes(id, type, name, ord), mentions(id, source, ord), edges(subject, predicate,
object, confidence, extracted_by, source, ord). ``ord`` is a struct that orders rows as
their fragments and positions do; "first" always means the least ``ord``. Which sources
mention a node is a table of its own, so no node gathers an unbounded list; see
:func:`node_documents` for nodes with arrays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgraph.functions import names, noise
from docgraph.functions.names import MENTIONED_IN, RELATED_TO, SOURCE_TYPE, TYPE_PRIORITY
from docgraph.operators.ranking import rank_within
from docgraph.sources import scratch


#: Sources of a node in one published row.
PART_SOURCES = 10_000


def merge_nodes(nodes: DataFrame) -> DataFrame:
    """id, type, name, ord: of rows with one id the first decides."""
    best = F.min(F.struct("ord", "type", "name")).alias("best")
    return nodes.groupBy("id").agg(best).select("id", "best.type", "best.name", "best.ord")


def merge_mentions(mentions: DataFrame) -> DataFrame:
    """id, source, ord: each pair once, with its first place."""
    return mentions.filter("source <> ''").groupBy("id", "source").agg(F.min("ord").alias("ord"))


def mention_counts(mentions: DataFrame) -> DataFrame:
    """id, mention_count, first_source of merged mentions."""
    return mentions.groupBy("id").agg(F.count("*").alias("mention_count"), F.min(F.struct("ord", "source"))["source"].alias("first_source"))


def mention_parts(mentions: DataFrame, size: int = PART_SOURCES) -> DataFrame:
    """id, part, sources: each node's sources in order of appearance, in numbered parts of at most ``size``.

    No task gathers the list of a hub: a rank over all mentions, less the rank at
    which the node begins, tells the part.
    """
    numbered = batches(mentions.select("id", "source", "ord"), [F.col("ord"), F.col("source")], size, ["id"])
    listed = F.transform(F.array_sort(F.collect_list(F.struct("ord", "source"))), lambda m: m["source"])
    return numbered.groupBy("id", F.col("batch").alias("part")).agg(listed.alias("sources"))


def node_documents(nodes: DataFrame, mentions: DataFrame, size: int = PART_SOURCES) -> DataFrame:
    """Merged nodes with ``aliases`` (always empty) and ``mentioned_in`` in order of appearance, as published.

    A node with more than ``size`` sources has several rows, by ``part`` from 0.
    """
    empty = F.array().cast("array<string>")
    joined = nodes.join(mention_parts(mentions, size), "id", "left")
    return joined.select("id", "type", "name", empty.alias("aliases"), F.coalesce("sources", empty).alias("mentioned_in"), F.coalesce("part", F.lit(0)).cast("long").alias("part"), "ord")


def merge_edges(edges: DataFrame) -> DataFrame:
    """One edge per (subject, predicate, object): the highest confidence, its first extractor, the number of sources.

    A missing confidence counts as 0. Sources are folded before edges are, so that
    the number of sources needs no list.
    """
    key = ["subject", "predicate", "object"]
    # Least first: highest confidence, then earliest place.
    best = F.struct((-F.coalesce("confidence", F.lit(0.0))).alias("minus"), "ord", "extracted_by")
    by_source = edges.groupBy(*key, "source").agg(F.min(best).alias("best"), F.min("ord").alias("ord"))
    merged = by_source.groupBy(*key).agg(F.min("best").alias("best"), F.min(F.struct("ord", "source")).alias("first"), F.count_if(F.col("source") != "").alias("n_sources"))
    return merged.select(*key, (-F.col("best.minus")).alias("confidence"), "best.extracted_by", "n_sources", F.col("first.source").alias("first_source"), F.col("first.ord").alias("ord"))


def type_counts(nodes: DataFrame) -> DataFrame:
    """Nodes by type; no type counts as Thing."""
    return nodes.groupBy(F.coalesce("type", F.lit("Thing")).alias("type")).agg(F.count("*").alias("n"))


def stats(nodes: DataFrame, edges: DataFrame, mentions: DataFrame) -> DataFrame:
    """One row: entities, relationships and sources of a merged graph."""
    kinds = [nodes.select(F.lit("node").alias("kind")), edges.select(F.lit("edge")), mentions.select("source").distinct().select(F.lit("source"))]
    every = kinds[0].union(kinds[1]).union(kinds[2])

    def count(kind: str, name: str) -> Column:
        return F.count_if(F.col("kind") == kind).alias(name)

    return every.agg(count("node", "total_entities"), count("edge", "total_relationships"), count("source", "total_sources"))


# --- fragments ---------------------------------------------------------------


def topics(sources: DataFrame, entities: DataFrame) -> DataFrame:
    """source, id, name, synthetic: the topic of each source (source, title).

    An entity (source, id, name, ord) whose name is the title is the topic, the
    first of them; else the one with the longest name that contains the title or is
    contained in it; else one is made up from the title.
    """
    title = F.lower(names.strip_prefixes(F.col("title"), names.MATCH_PREFIXES))
    joined = entities.join(sources.select("source", title.alias("wanted")), "source")
    name = F.lower("name")
    exact = name == F.col("wanted")
    near = F.contains(F.col("wanted"), name) | F.contains(name, F.col("wanted"))
    order = F.struct((~exact).alias("other"), F.when(~exact, -F.length("name")).alias("shorter"), "ord", "id", "name")
    found = joined.filter(exact | (near & (F.length("name") > 0))).groupBy("source").agg(F.min(order).alias("best"))
    made = names.topic_name(F.col("title"))
    picked = sources.join(found, "source", "left")
    synthetic = F.col("best").isNull()
    return picked.select(
        "source",
        F.when(synthetic, F.concat(F.lit("entity:event-"), names.slug_nfkd(made))).otherwise(F.col("best.id")).alias("id"),
        F.when(synthetic, made).otherwise(F.col("best.name")).alias("name"),
        synthetic.alias("synthetic"),
    )


def fragment_edges(entities: DataFrame, extracted: DataFrame, topic: DataFrame) -> DataFrame:
    """All edges of fragments: mentions, extracted relationships, and links to topics.

    ``entities`` (source, id), ``extracted`` (source, subject, predicate in snake case,
    object, confidence, extracted_by), ``topic`` as :func:`topics` gives it. Entities in
    no extracted relationship are related to the topic.
    """
    by_pipeline = [F.lit("pipeline").alias("extracted_by")]
    mentioned = entities.select("source", "id").union(topic.filter("synthetic").select("source", "id"))
    edges = mentioned.select("source", F.col("id").alias("subject"), F.lit(MENTIONED_IN).alias("predicate"), F.col("source").alias("object"), F.lit(1.0).alias("confidence"), *by_pipeline)
    predicate = F.concat(F.lit(names.NAMESPACE), names.camel_case(F.col("predicate")))
    edges = edges.union(extracted.select("source", "subject", predicate.alias("predicate"), "object", "confidence", "extracted_by"))
    linked = extracted.select("source", F.explode(F.array("subject", "object")).alias("id")).distinct()
    loose = entities.select("source", "id").join(linked, ["source", "id"], "left_anti").join(topic.select("source", F.col("id").alias("topic")), "source").filter("id <> topic")
    return edges.union(loose.select("source", F.col("id").alias("subject"), F.lit(RELATED_TO).alias("predicate"), F.col("topic").alias("object"), F.lit(0.3).alias("confidence"), *by_pipeline))


def fragment_nodes(sources: DataFrame, entities: DataFrame, topic: DataFrame) -> DataFrame:
    """source, id, type, name: a node for each source, each entity (source, id, label, name) and each made-up topic."""
    own = sources.select("source", F.col("source").alias("id"), F.lit(SOURCE_TYPE).alias("type"), F.col("title").alias("name"))
    found = entities.select("source", "id", names.schema_type(F.col("label")).alias("type"), "name")
    return own.union(found).union(topic.filter("synthetic").select("source", "id", F.lit("Event").alias("type"), "name"))


# --- cleaning ----------------------------------------------------------------


def without_edges_of(edges: DataFrame, removed: DataFrame) -> DataFrame:
    """Edges neither end of which is among ``removed`` (id)."""
    edges = edges.join(removed.select(F.col("id").alias("subject")), "subject", "left_anti")
    return edges.join(removed.select(F.col("id").alias("object")), "object", "left_anti")


def drop_noise(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    noisy = noise.is_graph_noise(F.col("name"), F.col("type"))
    return nodes.filter(~noisy), without_edges_of(edges, nodes.filter(noisy).select("id"))


def type_votes(nodes: DataFrame) -> DataFrame:
    """name, best_type for names with several types: the most frequent one, ties by priority."""
    votes = nodes.filter(F.col("type") != SOURCE_TYPE).groupBy("name", "type").agg(F.count("*").alias("n"))
    priority = names.lookup(F.col("type"), TYPE_PRIORITY, F.lit(0))
    best = F.max(F.struct("n", priority.alias("priority"), "type"))
    return votes.groupBy("name").agg(best.alias("best"), F.count("*").alias("types")).filter("types > 1").select("name", F.col("best.type").alias("best_type"))


def merge_names(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes with one node per name, the first, under its best type; and id, canonical of those merged away."""
    named = nodes.filter(F.col("type") != SOURCE_TYPE)
    first = named.groupBy("name").agg(F.min(F.struct("ord", "id", "type")).alias("first"))
    kept = first.join(type_votes(nodes), "name", "left").select(F.col("first.id").alias("id"), F.coalesce("best_type", "first.type").alias("type"), "name", F.col("first.ord").alias("ord"))
    merged = named.select("id", "name").join(first.select("name", F.col("first.id").alias("canonical")), "name").filter("id <> canonical").select("id", "canonical")
    return nodes.filter(F.col("type") == SOURCE_TYPE).select("id", "type", "name", "ord").union(kept), merged


def rewrite_edges(edges: DataFrame, merged: DataFrame) -> DataFrame:
    """Ends replaced by their canonical nodes; no loops; of edges that become equal the first stays."""
    subject = merged.select(F.col("id").alias("subject"), F.col("canonical").alias("new_subject"))
    object_ = merged.select(F.col("id").alias("object"), F.col("canonical").alias("new_object"))
    moved = edges.join(subject, "subject", "left").join(object_, "object", "left")
    moved = moved.withColumns({"subject": F.coalesce("new_subject", "subject"), "object": F.coalesce("new_object", "object")}).drop("new_subject", "new_object")
    rest = [c for c in edges.columns if c not in ("subject", "predicate", "object", "ord")]
    first = F.min(F.struct("ord", *rest)).alias("first")
    return moved.filter("subject <> object").groupBy("subject", "predicate", "object").agg(first).select("subject", "predicate", "object", *(f"first.{c}" for c in rest), "first.ord")


def drop_orphans(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Without nodes that no edge besides mentions links to anything but a source."""
    sources = nodes.filter(F.col("type") == SOURCE_TYPE).select("id")
    visible = without_edges_of(edges.filter(F.col("predicate") != MENTIONED_IN), sources)
    linked = visible.select(F.explode(F.array("subject", "object")).alias("id")).distinct()
    orphans = nodes.filter(F.col("type") != SOURCE_TYPE).join(linked, "id", "left_anti").select("id")
    return nodes.join(orphans, "id", "left_anti"), without_edges_of(edges, orphans)


def clean(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Noise removal, name merging, edge rewriting, orphan removal; also id, canonical of merged nodes.

    Each step looks at its tables several times, so they are written in between.
    """
    folder = scratch.new_folder(nodes.sparkSession, "clean")
    quiet, edges = drop_noise(nodes, edges)
    quiet = scratch.materialise(quiet, folder, "nodes_1")
    named, merged = merge_names(quiet)
    named, merged = scratch.materialise(named, folder, "nodes_2"), scratch.materialise(merged, folder, "merged")
    rewritten = scratch.materialise(rewrite_edges(edges, merged), folder, "edges")
    kept_nodes, kept_edges = drop_orphans(named, rewritten)
    return kept_nodes, kept_edges, merged


def moved_mentions(mentions: DataFrame, merged: DataFrame) -> DataFrame:
    """Mentions of merged nodes pass to their canonical node."""
    moved = mentions.join(merged, "id", "left").withColumn("id", F.coalesce("canonical", "id"))
    return merge_mentions(moved.drop("canonical"))


# --- verdicts ----------------------------------------------------------------


def apply_removals(nodes: DataFrame, edges: DataFrame, removed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Without the nodes that a verdict (id) removes, and their edges."""
    return nodes.join(removed.select("id"), "id", "left_anti"), without_edges_of(edges, removed)


def people_groups(nodes: DataFrame) -> DataFrame:
    """surname, id, name, ord of people who share a surname; initials alone never group."""
    people = nodes.filter((F.col("type") == "Person") & ~noise.is_initials(F.col("name"))).withColumn("surname", noise.surname(F.col("name"))).filter("surname is not null")
    shared = people.groupBy("surname").agg(F.count("*").alias("n")).filter("n > 1").select("surname")
    return people.join(shared, "surname").select("surname", "id", "name", "ord")


def _groups(members: DataFrame, by: list[str]) -> DataFrame:
    """id, canonical, canonical_name of groups: ``members`` (by, at, id, ord, canonical_name), the first of a group is canonical.

    Groups with one known member don't count. Where an id is in several groups, the one said last decides.
    """
    named = members.groupBy(*by, "at", "id").agg(F.min("ord").alias("ord"), F.first("canonical_name").alias("canonical_name"))
    heads = named.groupBy(*by, "at").agg(F.min(F.struct("ord", "id"))["id"].alias("canonical"), F.count("*").alias("n")).filter("n > 1").drop("n")
    said = named.join(heads, [*by, "at"])
    last = F.max(F.struct("at", "canonical", "canonical_name")).alias("last")
    renamed = said.filter("id = canonical").groupBy("id").agg(last)
    merged = said.filter("id <> canonical").groupBy("id").agg(last)
    return renamed.union(merged).select("id", "last.canonical", "last.canonical_name")


_PEOPLE_REPLY = "groups array<array<string>>, canonical map<string,string>, not_people array<string>"
_ORG_REPLY = "merge_groups array<array<string>>, canonical map<string,string>, not_orgs array<string>"


def people_verdicts(people: DataFrame, replies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Groups (id, canonical, canonical_name) and removals (id) from replies (surname, reply) about people who share a surname.

    ``people`` as :func:`people_groups` gives them. A group names variants; its
    members are the people of that surname with such a name, its name the one that
    the reply maps its first mapped variant to, else its longest variant (the first
    of them). A reply that isn't an object says nothing.
    """
    told = replies.select("surname", F.from_json("reply", _PEOPLE_REPLY).alias("r"))
    groups = told.select("surname", "r.canonical", F.posexplode("r.groups").alias("at", "variants")).filter(F.size("variants") > 1)
    mapped = F.filter(F.transform("variants", lambda v: F.try_element_at("canonical", v)), lambda n: n.isNotNull())
    first_mapped = F.when(F.col("canonical").isNotNull(), F.get(mapped, F.lit(0)))
    longest = F.aggregate("variants", F.lit(""), lambda best, v: F.when(F.length(v) > F.length(best), v).otherwise(best))
    groups = groups.select("surname", "at", "variants", F.coalesce(F.when(first_mapped != "", first_mapped), longest).alias("canonical_name"))
    wanted = groups.select("surname", "at", "canonical_name", F.explode(F.array_distinct("variants")).alias("name"))
    removed = told.select("surname", F.explode("r.not_people").alias("name")).distinct()
    return _groups(people.join(wanted, ["surname", "name"]), ["surname"]), people.join(removed, ["surname", "name"], "left_semi").select("id").distinct()


def org_verdicts(orgs: DataFrame, replies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Groups and removals from replies (batch, reply) about organizations (batch, id, name, ord).

    Of organizations of one name in a batch the last counts. The first name of a
    group that is known stands for it; the group's name is what the reply maps its
    first name to, or that name.
    """
    known = orgs.groupBy("batch", "name").agg(F.max(F.struct("ord", "id"))["id"].alias("id"))
    told = replies.select("batch", F.from_json("reply", _ORG_REPLY).alias("r"))
    groups = told.select("batch", "r.canonical", F.posexplode("r.merge_groups").alias("at", "listed")).filter(F.size("listed") > 1)
    first = F.get("listed", F.lit(0))
    called = F.coalesce(F.when(F.col("canonical").isNotNull(), F.try_element_at("canonical", first)), first)
    members = groups.select("batch", "at", called.alias("canonical_name"), F.posexplode("listed").alias("ord", "name"))
    removed = told.select("batch", F.explode("r.not_orgs").alias("name")).distinct()
    return _groups(members.join(known, ["batch", "name"]), ["batch"]), known.join(removed, ["batch", "name"], "left_semi").select("id").distinct()


def apply_groups(nodes: DataFrame, edges: DataFrame, groups: DataFrame, remove: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Merge verdict groups (id, canonical, canonical_name) and remove further ids with their edges.

    The canonical node takes the canonical name; the others go, and so do their
    mentions. Ids are replaced once, not transitively.
    """
    merged = groups.filter("id <> canonical").select("id", "canonical")
    gone = merged.select("id").union(remove.select("id")).distinct()
    renamed = groups.filter("id = canonical").select("id", "canonical_name").distinct()
    out = nodes.join(gone, "id", "left_anti").join(renamed, "id", "left").withColumn("name", F.coalesce("canonical_name", "name")).drop("canonical_name")
    return out, rewrite_edges(without_edges_of(edges, remove.select("id").distinct()), merged)


def batches(df: DataFrame, order: list[Column], size: int, within: list[str]) -> DataFrame:
    """``batch``: consecutive groups of ``size`` rows, in order, within each partition key."""
    return rank_within(df, within, order, "__place").withColumn("batch", F.floor(F.col("__place") / size)).drop("__place")
