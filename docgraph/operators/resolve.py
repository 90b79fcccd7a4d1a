"""Resolving entities against a registry, and places against a gazetteer."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docgraph.functions import noise
from docgraph.operators.components import components
from docgraph.operators.ranking import global_rank
from docgraph.sources import scratch

AMBIGUITY = 0.15
MAX_CANDIDATES = 5
#: Entities that one pass of the disambiguation is meant to take.
SHARE = 5000


def by_id(entities: DataFrame, registry: DataFrame) -> DataFrame:
    """entities (id, ...) with ``found``: the registry id that equals theirs."""
    return entities.join(registry.select("id", F.col("id").alias("found")).distinct(), "id", "left")


def name_index(registry: DataFrame) -> DataFrame:
    """type, name, found: the first registry entry under each name or alias of a type."""
    every = registry.select("type", "id", "ord", F.explode(F.array_append(F.coalesce("aliases", F.array().cast("array<string>")), F.col("name"))).alias("name"))
    return every.groupBy("type", "name").agg(F.min(F.struct("ord", "id"))["id"].alias("found"))


def by_name(entities: DataFrame, registry: DataFrame) -> DataFrame:
    """entities (type, name, ...) with ``found``: the first registry entry of their type with that name or alias."""
    return entities.join(name_index(registry), ["type", "name"], "left")


@F.pandas_udf(T.DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Matching-blocks ratio of lower-cased names; the order of the two matters."""

    def ratio(x: str, y: str) -> float:
        return SequenceMatcher(None, x.lower(), y.lower()).ratio()

    return pd.Series([ratio(x, y) for x, y in zip(a, b, strict=True)], dtype=float)


def _letters(name: Column) -> Column:
    """The characters of a lower-cased name as a number: sixteen kinds of them, each counted by up to four bits."""

    def count(bits: Column, c: Column) -> Column:
        place = (F.ascii(c) % 16 * 4).cast("int")
        left = F.call_function("shiftrightunsigned", bits, place).bitwiseAND(15)
        return bits.bitwiseOR(F.call_function("shiftleft", (left + 1).bitwiseAND(15), place))

    return F.aggregate(F.split(name, ""), F.lit(0).cast("long"), count)


def _plan(asked: DataFrame, there: DataFrame, threshold: float) -> DataFrame:
    """type, a, b, edits, n: the pairs of lengths of names that can be similar, how much of both may be left over, the parts of the second."""
    total = F.col("a") + F.col("b")
    matching = F.ceil(total * threshold / 2 - 1e-9)
    pairs = asked.select("type", "a").distinct().join(there.select("type", "b").distinct(), "type").filter(matching <= F.least("a", "b"))
    pairs = pairs.withColumn("edits", (total - 2 * matching).cast("int"))
    return pairs.withColumn("n", F.least(F.col("edits") + 1, F.col("b")))


def _meetings(asked: DataFrame, there: DataFrame, plan: DataFrame) -> DataFrame:
    """w, o: pairs of names that have a part in common where they must, and characters enough."""
    starts, ends = F.floor(F.col("i") * F.col("b") / F.col("n")).cast("int"), F.floor((F.col("i") + 1) * F.col("b") / F.col("n")).cast("int")
    parts = F.explode(F.sequence(F.lit(0), F.col("n") - 1))

    def key(name: Column, at: Column) -> Column:
        return F.xxhash64("type", "b", "n", "i", F.substr(name, at + 1, F.col("size")))

    own = there.join(F.broadcast(plan.select("type", "b", "n").distinct()), ["type", "b"]).select("*", parts.alias("i")).withColumn("size", ends - starts)
    own = own.select(key(F.col("lower"), starts).alias("key"), F.col("hash").alias("o"), F.col("letters").alias("own_letters"))
    more, i, edits = F.col("a") - F.col("b"), F.col("i"), F.col("edits")
    few = F.col("n") <= edits  # shorter than it takes to have a part more than edits
    low = F.when(few, (more - edits) / 2).otherwise(F.greatest(-i, more - edits + i)).cast("int")
    high = F.when(few, (more + edits) / 2).otherwise(F.least(i, more + edits - i)).cast("int")
    ask = asked.join(F.broadcast(plan), ["type", "a"]).select("*", parts.alias("i")).withColumn("size", ends - starts).withColumn("start", starts)
    ask = ask.select("*", F.explode(F.when(low <= high, F.sequence(low, high))).alias("shift")).withColumn("at", F.col("start") + F.col("shift"))
    ask = ask.filter(few | (F.pmod(F.col("shift") - i, F.lit(2)) == 0)).filter("at >= 0 and at + size <= a")
    ask = ask.select(key(F.col("lower"), F.col("at")).alias("key"), F.col("hash").alias("w"), "letters", "edits")
    alike = F.bit_count(F.col("letters").bitwiseXOR(F.col("own_letters"))) <= F.col("edits")
    return ask.join(own, "key").filter(alike).select("w", "o").distinct()


def similar_names(wanted: DataFrame, owned: DataFrame, threshold: float) -> DataFrame:
    """Pairs of rows of ``wanted`` (type, wanted, ...) and ``owned`` (type, own, ...) whose names' ratio is ``threshold`` or more, with ``score``.

    The ratio is twice the matching characters over both lengths a and b. So at least
    m = ceil(threshold (a + b) / 2) characters match in the same order, and at most
    d = a + b - 2m are left over, each an insertion or a deletion. The second name is
    cut into d + 1 parts. For the first part i before whose end are at most i of them, exactly
    i lie before it and none in it: it stands in the other name, shifted by i or i less an even
    number to either side, and what follows must make up for the shift with the other d - i.
    A second name of fewer characters than d + 1 is cut into single characters, of which one stands
    somewhere that d allows. Distinct names meet by hashes of such parts in narrow rows and
    are dropped where counts of their characters differ by more than d. Hashes that collide only add pairs, as
    what is left is scored by its names, which is the only step in Python.
    """

    def names(df: DataFrame, name: str, length: str) -> DataFrame:
        lower = df.filter(F.col(name) != "").select("type", name).distinct().withColumn("lower", F.lower(name))
        return lower.select("type", name, "lower", F.length("lower").alias(length), F.xxhash64("type", name).alias("hash"), _letters(F.col("lower")).alias("letters"))

    asked, there = names(wanted, "wanted", "a"), names(owned, "own", "b")
    met = _meetings(asked, there, _plan(asked, there, threshold))
    pairs = met.join(asked.select("type", "wanted", F.col("hash").alias("w")), "w").join(there.select(F.col("type").alias("own_type"), "own", F.col("hash").alias("o")), "o")
    pairs = pairs.filter("type <=> own_type").select("type", "wanted", "own")
    # Names without characters match each other only.
    empty = wanted.filter("wanted = ''").select("type", "wanted").distinct().join(owned.filter("own = ''").select("type", "own").distinct(), "type")
    scored = pairs.union(empty).withColumn("score", similarity(F.col("wanted"), F.col("own"))).filter(F.col("score") >= threshold)
    columns = [*wanted.columns, *(c for c in owned.columns if c != "type"), "score"]
    return scored.join(wanted, ["type", "wanted"]).join(owned, ["type", "own"]).select(columns)


def _names_of(registry: DataFrame) -> DataFrame:
    """type, found, ord, pos, own: every name (pos 0) and alias of the registry."""
    listed = F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))
    return registry.select("type", F.col("id").alias("found"), "ord", F.posexplode(listed).alias("pos", "own"))


def fuzzy(entities: DataFrame, registry: DataFrame, threshold: float = 0.8) -> DataFrame:
    """entity, found, score, rank: registry entries of the same type whose name, or else an alias, is similar.

    Of an entry's aliases the first similar one counts. Entities: id, type, name.
    """
    asking = entities.select(F.col("id").alias("entity"), "type", F.col("name").alias("wanted"))
    scored = similar_names(asking, _names_of(registry), threshold)
    best = scored.groupBy("entity", "found").agg(F.min(F.struct("pos", "score", "ord")).alias("b")).select("entity", "found", "b.score", "b.ord")
    rank = F.row_number().over(Window.partitionBy("entity").orderBy(F.desc("score"), "ord", "found"))
    return best.withColumn("rank", rank).select("entity", "found", "score", "rank")


class Resolver:
    """The sequential pass over entities, in order; entities that don't depend on each other may come between.

    ``places`` tells the order of registry entries, ``confirmed`` the pairs of an entity and an entry
    that a verdict takes for the same.
    """

    def __init__(self, places: dict[str, int], confirmed: set[tuple[str, str]]) -> None:
        self.places, self.confirmed = places, confirmed
        self.names: dict[tuple[str, str], str] = {}  # (type, name) that this pass has given to entries
        self.new: dict[str, int] = {}  # entries that it has made, in order
        self.entry: dict[int, tuple[int, str]] = {}  # of names that an entry has got here: when, and the entry

    def take(self, key: int, id_: str, type_: str, name: str, known: list[tuple], alike: dict[int, float]) -> tuple[str, str]:
        """The canonical id of an entity whose name is number ``key``, and the step that gave it.

        ``known`` are similar names of the registry (entry, place of the name, score),
        ``alike`` the scores of other entities' similar names by the numbers of these.
        """
        if id_ in self.new:
            return id_, "id"
        if (type_, name) in self.names:
            return self.names[type_, name], "batch"
        scores = {found: score for found, _, score in sorted(known, key=lambda k: -k[1])}
        for other in sorted(alike.keys() & self.entry.keys(), key=self.entry.__getitem__):
            scores.setdefault(self.entry[other][1], alike[other])
        best = min(scores, key=lambda f: (-scores[f], f in self.new, self.new.get(f, self.places.get(f, 0))), default=None)
        same = (id_, best) in self.confirmed
        if not same:
            self.new[id_] = len(self.new)
        self.names[type_, name] = best if same else id_
        self.entry[key] = len(self.entry), self.names[type_, name]
        return self.names[type_, name], "fuzzy" if same else "new"


def disambiguate(entities: DataFrame, registry: DataFrame, verdicts: DataFrame | None = None, threshold: float = 0.7) -> DataFrame:
    """entities (id, type, name, ord) with ``canonical`` and ``step``: id, name, fuzzy, batch or new.

    The outcome is that of one pass in the order of ``ord`` over a registry that grows:
    the registry's entry of that id, its first entry of that name or alias, the most
    similar entry if a verdict (entity, found) confirms it, which then gets the name as
    an alias, else a new entry; later entities meet new entries and aliases.

    Only entities that no entry has by id or name are left for the pass. They depend
    on each other where names are alike or ids or names are the same, so the pass runs
    on each connected component of these relations by itself, small ones together. Without verdicts names
    needn't be alike, and everything is joins. Entities alike in id, type and name get
    what the first of them got.
    """
    first = by_id(entities, registry).withColumnRenamed("found", "same_id")
    second = first.join(name_index(registry).withColumnRenamed("found", "same_name"), ["type", "name"], "left")
    second = second.withColumn("known", F.coalesce("same_id", "same_name"))
    unknown = second.filter("known is null")
    if verdicts is None:
        in_batch = unknown.groupBy("type", "name").agg(F.min(F.struct("ord", "id"))["id"].alias("batch_first"))
        out = second.join(in_batch, ["type", "name"], "left")
        later = F.when(F.col("batch_first") != F.col("id"), "batch").otherwise("new")
    else:
        folder = scratch.new_folder(entities.sparkSession, "disambiguate")
        own = _pass(unknown.select("id", "type", "name", "ord"), registry, verdicts, threshold, folder)
        out = second.join(own, ["id", "type", "name"], "left")
        later = F.col("own_step")
    step = F.when(F.col("same_id").isNotNull(), "id").when(F.col("same_name").isNotNull(), "name").otherwise(later)
    canonical = F.coalesce("known", "batch_first")
    return out.select("id", "type", "name", "ord", canonical.alias("canonical"), step.alias("step"))


_PASS_DDL = "id string, type string, name string, batch_first string, own_step string"


def _pass(unknown: DataFrame, registry: DataFrame, verdicts: DataFrame, threshold: float, folder: str) -> DataFrame:
    """id, type, name, batch_first, own_step of each distinct unknown entity."""
    distinct = unknown.groupBy("id", "type", "name").agg(F.min("ord").alias("ord"))
    units = scratch.materialise(global_rank(distinct, [F.col("ord"), F.col("id"), F.col("name")], "key"), folder, "units").drop("ord")
    # What is alike is looked for once a name, which has the number of its first entity.
    named = scratch.materialise(units.groupBy("type", "name").agg(F.min("key").alias("first")), folder, "names")
    asking = named.select("first", "type", F.col("name").alias("wanted"))
    entries = scratch.materialise(global_rank(registry.select("id", "type", "name", "aliases", "ord"), [F.col("ord"), F.col("id")], "place"), folder, "registry")
    known = scratch.materialise(similar_names(asking, _names_of(entries.drop("ord").withColumnRenamed("place", "ord")), threshold).select("first", "found", F.col("ord").alias("place"), "pos", "score"), folder, "known")
    others = named.select("type", F.col("first").alias("other"), F.col("name").alias("own"))
    alike = scratch.materialise(similar_names(asking, others, threshold).filter("other <> first").select("first", "other", "score"), folder, "alike")
    numbered = scratch.materialise(units.join(named, ["type", "name"]), folder, "numbered")
    by_id = numbered.groupBy("id").agg(F.min("first").alias("b"))
    # Entities that could take up one entry's aliases are alike themselves, or don't meet through them.
    links = alike.select(F.col("first").alias("a"), F.col("other").alias("b")).union(numbered.join(by_id, "id").select("first", "b"))
    label = components(links, folder, "alike").withColumnRenamed("node", "first")
    by_name = known.groupBy("first").agg(F.collect_list(F.struct("found", "place", "pos", "score")).alias("known"))
    around = alike.groupBy("first").agg(F.collect_list(F.struct("other", "score")).alias("alike"))
    told = verdicts.select(F.col("entity").alias("id"), "found").groupBy("id").agg(F.collect_set("found").alias("confirmed"))
    rows = numbered.join(label, "first").join(by_name, "first", "left").join(around, "first", "left").join(told, "id", "left")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf.sort_values("key").to_dict("records")
        listed = lambda x: [] if x is None else list(x)
        places = {k["found"]: k["place"] for r in rows for k in listed(r["known"])}
        resolver = Resolver(places, {(r["id"], f) for r in rows for f in listed(r["confirmed"])})
        out = []
        for r in rows:
            known = [(k["found"], k["pos"], k["score"]) for k in listed(r["known"])]
            alike = {e["other"]: e["score"] for e in listed(r["alike"])}
            out.append((r["id"], r["type"], r["name"], *resolver.take(r["first"], r["id"], r["type"], r["name"], known, alike)))
        return pd.DataFrame(out, columns=["id", "type", "name", "batch_first", "own_step"])

    # Many small components share a task's pass.
    shares = max(1, -(-units.count() // SHARE))
    return rows.groupBy(F.pmod(F.xxhash64("label"), F.lit(shares))).applyInPandas(run, _PASS_DDL)


def grown_registry(registry: DataFrame, resolved: DataFrame) -> DataFrame:
    """registry (id, name, type, aliases, sources, ord) after :func:`disambiguate`: confirmed names as aliases, new entries at the end.

    ``ord`` of the registry and of ``resolved`` are numbers here. An alias that is already
    there isn't added again.
    """
    confirmed = resolved.filter("step = 'fuzzy'").groupBy("canonical", "name").agg(F.min("ord").alias("at"))
    added = confirmed.groupBy(F.col("canonical").alias("id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "name"))), lambda x: x["name"]).alias("more"))
    new = resolved.filter("step = 'new'").groupBy("id").agg(F.min(F.struct("ord", "name", "type")).alias("n"))
    empty = F.array().cast("array<string>")
    highest = registry.agg(F.max("ord")).head()[0]
    fresh = new.select("id", "n.name", "n.type", empty.alias("aliases"), empty.alias("sources"), (F.lit(0 if highest is None else highest + 1) + F.col("n.ord")).cast("long").alias("ord"))
    every = registry.select("id", "name", "type", F.coalesce("aliases", empty).alias("aliases"), F.coalesce("sources", empty).alias("sources"), F.col("ord").cast("long").alias("ord")).union(fresh)
    grown = every.join(added, "id", "left")
    return grown.withColumn("aliases", F.concat("aliases", F.array_except(F.coalesce("more", empty), "aliases"))).drop("more")


def relationship_ids(rows: DataFrame, entities: DataFrame) -> DataFrame:
    """Reply rows (source, subject, predicate, object, confidence) with names replaced by ids.

    A name matches exactly, else lower-cased; of entities with one name the last
    counts. Rows with an unknown name go. Entities: source, id, name, ord.
    """
    last = F.max(F.struct("ord", "id"))["id"]
    exact = entities.groupBy("source", "name").agg(last.alias("id"))
    lower = entities.groupBy("source", F.lower("name").alias("name")).agg(last.alias("lower_id"))
    for end in ("subject", "object"):
        rows = rows.join(exact.select("source", F.col("name").alias(end), F.col("id").alias("exact_id")), ["source", end], "left").withColumn("name", F.lower(end))
        rows = rows.join(lower, ["source", "name"], "left").withColumn(end, F.coalesce("exact_id", "lower_id")).drop("exact_id", "lower_id", "name").filter(F.col(end).isNotNull())
    return rows


# --- places ------------------------------------------------------------------


def ranked_candidates(candidates: DataFrame) -> DataFrame:
    """Up to five candidates per place_name by confidence (rounded), with ``rank`` and the ``gap`` to the next one."""
    rounded = candidates.withColumn("confidence", F.round("confidence", 4))
    w = Window.partitionBy("place_name").orderBy(F.desc("confidence"), "ord")
    return rounded.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= MAX_CANDIDATES).withColumn("gap", F.col("confidence") - F.lead("confidence").over(w))


def is_ambiguous() -> Column:
    return (F.col("rank") == 1) & (F.col("gap") < AMBIGUITY)


def picked_rank(reply: Column, n: Column) -> Column:
    """The candidate that a reply's first digit names, else the best one."""
    digit = F.regexp_extract(F.coalesce(reply, F.lit("")), r"\d", 0).try_cast("int")
    return F.when(digit.between(1, n), digit).otherwise(1)


def place_inputs(nodes: DataFrame, snippets: int = 3, length: int = 200) -> DataFrame:
    """id, name, context of nodes (id, type, name, snippets) that can be looked up: places with an id and a name; the first snippets, cut."""
    listed = F.transform(F.slice(F.coalesce("snippets", F.array().cast("array<string>")), F.lit(1), F.lit(snippets)), lambda s: F.substring(s, 1, length))
    usable = F.col("type").isin(noise.PLACE_TYPES) & (F.coalesce("id", F.lit("")) != "") & (F.coalesce("name", F.lit("")) != "")
    return nodes.filter(usable).select("id", "name", listed.alias("context"))


def geocode(places: DataFrame, candidates: DataFrame, replies: DataFrame, misses: DataFrame) -> DataFrame:
    """id, name, lat, lng, confidence, reason: exactly one of coordinates and reason is null.

    ``places`` (id, name); ``candidates`` (place_name, lat, lng, confidence, ord);
    ``replies`` (place_name, reply) settle ambiguous names; ``misses`` (id, cached) are
    lookups known to have failed: null for none, anything else for a corrupt entry.
    """
    ranked = ranked_candidates(candidates)
    per = ranked.groupBy("place_name").agg(F.count("*").alias("n"), F.max(is_ambiguous()).alias("ambiguous"))
    choice = per.join(replies, "place_name", "left").select("place_name", F.when(F.col("ambiguous"), picked_rank(F.col("reply"), F.col("n"))).otherwise(1).alias("rank"))
    best = ranked.join(choice, ["place_name", "rank"]).select(F.col("place_name").alias("name"), "lat", "lng", "confidence")
    known = misses.select("id", F.lit(True).alias("missed"), "cached")
    joined = places.join(known, "id", "left").join(best, "name", "left")
    reason = (
        F.when(~noise.is_geocodable(F.col("name")), "noise_filtered")
        .when(F.col("missed") & F.col("cached").isNull(), "no_results_cached")
        .when(F.col("missed"), "cache_corrupt")
        .when(F.col("lat").isNull(), "no_results")
    )
    joined = joined.withColumn("reason", reason)
    found = F.col("reason").isNull()
    return joined.select("id", "name", *(F.when(found, F.col(c)).alias(c) for c in ("lat", "lng", "confidence")), "reason")
