"""Graph, view, resolution, timeline, detection, manifest and streaming operators."""

from __future__ import annotations

import json
import math
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from docgraph import __main__ as cli
from docgraph.operators import crawl, detections, graph, process, ranking, resolve, timeline, views
from docgraph.plans import projections, view_queries
from docgraph.sources import convert, fragments, manifests, providers, publish, scratch
from docgraph.streaming import incremental


def write(folder, **files):
    folder.mkdir(exist_ok=True)
    for name, data in files.items():
        (folder / f"{name}.jsonld").write_text(json.dumps(data))
    return str(folder)


def edge(s, p, o, confidence=0.5, by="m"):
    return {"@type": "woo:Relationship", "subject": s if isinstance(s, dict) else {"@id": s}, "predicate": p, "object": {"@id": o}, "confidence": confidence, "extractedBy": by}


@pytest.fixture
def merged(spark, tmp_path):
    a = {"@id": "source:a", "entities": [{"@id": "e:1", "@type": "Person", "name": "One", "mentionedIn": "source:a"}, {"@id": "e:2", "@type": "Place", "name": "Two", "mentionedIn": "source:a"}], "relationships": [edge("e:1", "woo:bornIn", "e:2", 0.7, "x"), edge("e:1", "woo:bornIn", "e:2", 0.7, "later")]}
    b = {"@id": "source:b", "entities": [{"@id": "e:1", "@type": "Person", "name": "Uno", "mentionedIn": ["source:b", "source:a"]}], "relationships": [edge({"@id": "e:1"}, "woo:bornIn", "e:2", 0.95, "y")]}
    c = {"@id": "source:c", "entities": []}
    nodes, mentions, edges = fragments.fragment_tables(fragments.read_fragments(spark, write(tmp_path / "f", a=a, b=b, c=c)))
    return graph.merge_nodes(nodes), graph.merge_mentions(mentions), graph.merge_edges(edges)


def test_merge(merged):
    nodes, mentions, edges = merged
    documents = {r["id"]: r for r in graph.node_documents(nodes, mentions).collect()}
    assert documents["e:1"]["name"] == "One" and documents["e:1"]["mentioned_in"] == ["source:a", "source:b"]
    assert documents["e:2"]["mentioned_in"] == ["source:a"] and documents["e:2"]["aliases"] == []
    (e,) = edges.collect()
    assert (e["confidence"], e["extracted_by"], e["n_sources"], e["first_source"]) == (0.95, "y", 2, "source:a")
    assert graph.stats(nodes, edges, mentions).head().asDict() == {"total_entities": 2, "total_relationships": 1, "total_sources": 2}


def test_first_wins_among_equals(spark, tmp_path):
    data = {"@id": "source:a", "entities": [], "relationships": [edge("x", "p", "y", 0.7, "first"), edge("x", "p", "y", 0.7, "second"), {"subject": "x", "predicate": "q", "object": "y"}]}
    _, _, edges = fragments.fragment_tables(fragments.read_fragments(spark, write(tmp_path / "g", a=data)))
    found = {r["predicate"]: r for r in graph.merge_edges(edges).collect()}
    assert found["p"]["extracted_by"] == "first" and found["q"]["confidence"] == 0.0


def test_no_fragments(spark, tmp_path):
    tables = fragments.fragment_tables(fragments.read_fragments(spark, str(tmp_path / "missing")))
    assert [t.count() for t in tables] == [0, 0, 0]
    assert fragments.read_context(spark, str(tmp_path / "none.json")) == {}
    (tmp_path / "c.json").write_text('{"@context": {"a": 1}}')
    assert fragments.read_context(spark, str(tmp_path / "c.json")) == {"a": 1}


def test_merge_is_idempotent(merged):
    nodes, _, edges = merged
    again = graph.merge_edges(edges.withColumn("source", F.col("first_source")))
    assert again.select("subject", "confidence").collect() == edges.select("subject", "confidence").collect()
    assert graph.merge_nodes(nodes).count() == nodes.count()


def nodes_of(spark, rows):
    return spark.createDataFrame([(i, t, n, k) for k, (i, t, n) in enumerate(rows)], "id string, type string, name string, ord int")


def edges_of(spark, rows):
    return spark.createDataFrame([(*r, 0.5, k) for k, r in enumerate(rows)], "subject string, predicate string, object string, confidence double, ord int")


def test_clean(spark):
    nodes = nodes_of(spark, [("s", "woo:Source", "S"), ("a", "Person", "Same Name"), ("b", "Organization", "Same Name"), ("c", "Organization", "Same Name"), ("d", "Place", "ab"), ("e", "Date", "someday soon"), ("f", "Place", "Far Place"), ("g", "Person", "Lonely One"), ("h", "Person", "Twin Name"), ("i", "Place", "Twin Name")])
    edges = edges_of(spark, [("a", "woo:knows", "b"), ("b", "woo:at", "f"), ("c", "woo:at", "f"), ("a", "woo:at", "d"), ("g", "woo:mentionedIn", "s"), ("h", "woo:at", "f"), ("g", "woo:about", "s")])
    n, e, merged = graph.clean(nodes, edges)
    assert sorted(map(tuple, n.select("id", "type").collect())) == [("a", "Organization"), ("f", "Place"), ("h", "Person"), ("s", "woo:Source")]
    assert sorted(map(tuple, merged.collect())) == [("b", "a"), ("c", "a"), ("i", "h")]
    assert sorted(map(tuple, e.select("subject", "object").collect())) == [("a", "f"), ("h", "f")]


def test_people_merge(spark):
    nodes = nodes_of(spark, [("a", "Person", "Ann Smith"), ("b", "Person", "A. Smith"), ("c", "Person", "J. R."), ("d", "Person", "Bo Jones")])
    assert sorted(r["id"] for r in graph.people_groups(nodes).collect()) == ["a", "b"]
    edges = edges_of(spark, [("b", "p", "d"), ("c", "p", "d"), ("a", "p", "b")])
    groups = spark.createDataFrame([("a", "a", "Ann B. Smith"), ("b", "a", "Ann B. Smith")], "id string, canonical string, canonical_name string")
    n, e = graph.apply_groups(nodes, edges, groups, nodes.filter("id = 'c'").select("id"))
    assert sorted(map(tuple, n.select("id", "name").collect())) == [("a", "Ann B. Smith"), ("d", "Bo Jones")]
    assert [tuple(r) for r in e.select("subject", "object").collect()] == [("a", "d")]


def test_fragment(spark):
    sources = spark.createDataFrame([("source:n", "Nimitz Biography")], "source string, title string")
    entities = spark.createDataFrame([("source:n", "entity:person-chester-nimitz", "PERSON", "Chester Nimitz", 0), ("source:n", "entity:event-midway", "EVENT", "Midway", 1)], "source string, id string, label string, name string, ord int")
    none = spark.createDataFrame([], "source string, subject string, predicate string, object string, confidence double, extracted_by string")
    topic = graph.topics(sources, entities)
    assert topic.head()["id"] == "entity:event-nimitz-biography" and topic.head()["synthetic"]
    assert graph.fragment_nodes(sources, entities, topic).count() == 4
    edges = graph.fragment_edges(entities, none, topic)
    assert {r["predicate"]: r["n"] for r in edges.groupBy("predicate").agg(F.count("*").alias("n")).collect()} == {"woo:mentionedIn": 3, "woo:relatedTo": 2}


def test_components_and_views(spark):
    rng = random.Random(4)
    pairs = [(f"n{rng.randrange(60):02}", "p", f"n{rng.randrange(60):02}") for _ in range(40)]
    found = {r["id"]: r["label"] for r in views.node_components(edges_of(spark, pairs)).collect()}
    parent: dict[str, str] = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, _, b in pairs:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    assert found == {x: root(x) for x in parent}
    nodes = nodes_of(spark, [(f"n{i:02}", "Person", f"N {i}") for i in range(60)])
    sizes = {r: sum(root(f"n{i:02}") == r for i in range(60)) for r in {root(f"n{i:02}") for i in range(60)}}
    assert views.largest_component(nodes, edges_of(spark, pairs)).count() == max(sizes.values())
    assert views.graph_view(nodes, edges_of(spark, pairs), min_degree=50).count() == 0
    loops = views.degrees(edges_of(spark, [("a", "p", "a"), ("a", "p", "b")])).collect()
    assert {r["id"]: r["degree"] for r in loops} == {"a": 3, "b": 1}


def union_find(pairs):
    """Each node's smallest companion."""
    parent: dict[str, str] = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent.setdefault(parent[x], parent[x])
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    return {x: root(x) for x in parent}


def test_component_queries_cover_all_edges(spark, sf_dir):
    nodes, edges = projections.dirty(spark, sf_dir)
    pairs = [(r["subject"], r["object"]) for r in edges.collect()]
    want = union_find(pairs)
    assert {r["id"]: r["label"] for r in view_queries.QUERIES["node_components"](spark, sf_dir).collect()} == want
    sizes = Counter(want.get(r["id"], r["id"]) for r in nodes.collect())
    assert view_queries.QUERIES["largest_component"](spark, sf_dir).count() == max(sizes.values())
    several = union_find((a, b) for a, b in pairs if b.startswith("source:") or a.startswith("entity:organization-") and b.startswith("entity:person-"))
    assert len(set(several.values())) > 50
    assert {r["id"]: r["label"] for r in view_queries.QUERIES["customer_components"](spark, sf_dir).collect()} == several


def test_long_chain_is_one_component(spark):
    chain = [(f"c{i:03}", "p", f"c{i + 1:03}") for i in range(200)]
    random.Random(1).shuffle(chain)
    assert {r["label"] for r in views.node_components(edges_of(spark, chain)).collect()} == {"c000"}


def test_global_rank(spark):
    values = random.Random(2).sample(range(1000), 300)
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(7)
    assert [r["rank"] for r in sorted(ranking.global_rank(df, [F.col("v")]).collect(), key=lambda r: r["v"])] == list(range(300))


# --- resolution ---------------------------------------------------------------------


def test_disambiguation(spark):
    registry = spark.createDataFrame([("p:john", "John F. Kennedy", "PERSON", ["JFK", "Jack"], 0), ("p:other", "Jack", "PERSON", [], 1)], "id string, name string, type string, aliases array<string>, ord int")
    entities = spark.createDataFrame([("p:john", "PERSON", "whoever", 0), ("x:1", "PERSON", "Jack", 1), ("x:2", "PERSON", "John Kennedy", 2), ("x:3", "ORG", "JFK", 3), ("x:4", "PERSON", "New One", 4), ("x:5", "PERSON", "New One", 5)], "id string, type string, name string, ord int")
    fuzzy = resolve.fuzzy(entities, registry, 0.7).collect()
    assert [(r["entity"], r["found"], r["rank"]) for r in fuzzy if r["entity"] == "x:2"] == [("x:2", "p:john", 1)]
    verdicts = spark.createDataFrame([("x:2", "p:john")], "entity string, found string")
    out = {r["id"]: (r["canonical"], r["step"]) for r in resolve.disambiguate(entities, registry, verdicts).collect()}
    assert out == {"p:john": ("p:john", "id"), "x:1": ("p:john", "name"), "x:2": ("p:john", "fuzzy"), "x:3": ("x:3", "new"), "x:4": ("x:4", "new"), "x:5": ("x:4", "batch")}
    assert {r["id"]: r["step"] for r in resolve.disambiguate(entities, registry).collect()}["x:2"] == "new"


def test_fuzzy_prune_is_safe(spark):
    rng = random.Random(6)
    name = lambda: "".join(rng.choices("abcde ", k=rng.randint(1, 12)))
    left, right = [(f"l{i}", "T", name()) for i in range(60)], [(f"r{i}", name(), "T", [], i) for i in range(60)]
    registry = spark.createDataFrame(right, "id string, name string, type string, aliases array<string>, ord int")
    found = {(r["entity"], r["found"]) for r in resolve.fuzzy(spark.createDataFrame(left, "id string, type string, name string"), registry, 0.7).collect()}
    from difflib import SequenceMatcher

    assert found == {(a, b) for a, _, x in left for b, y, *_ in right if SequenceMatcher(None, x.lower(), y.lower()).ratio() >= 0.7}


def one_pass(entities, registry, verdicts, threshold):
    """The pass as a loop over a growing registry of dictionaries."""
    from difflib import SequenceMatcher

    alike = lambda a, b: SequenceMatcher(None, a.lower(), b.lower()).ratio()
    known = {i: {"name": n, "type": t, "aliases": list(a)} for i, n, t, a, _ in registry}
    out = []
    for i, t, n, _ in entities:
        if i in known:
            out.append((i, "id"))
            continue
        named = next((k for k, e in known.items() if e["type"] == t and (e["name"] == n or n in e["aliases"])), None)
        if named:
            out.append((named, "named"))
            continue
        scored = []
        for k, e in known.items():
            own = next((s for x in (e["name"], *e["aliases"]) if (s := alike(n, x)) >= threshold), None) if e["type"] == t else None
            if own is not None:
                scored.append((-own, len(scored), k))
        if scored and (i, min(scored)[2]) in verdicts:
            best = min(scored)[2]
            known[best]["aliases"].append(n)
            out.append((best, "fuzzy"))
            continue
        known[i] = {"name": n, "type": t, "aliases": []}
        out.append((i, "new"))
    return out, known


@pytest.mark.parametrize("seed", range(3))
def test_disambiguation_is_the_sequential_pass(spark, seed):
    rng = random.Random(seed)
    stems = ["johnson", "johnsen", "jonson", "johnston", "smith", "smyth", "smithe", "brown", "browne"]
    registry = [(f"r{k}", rng.choice(stems), rng.choice("PO"), rng.sample(stems, rng.randint(0, 1)), k) for k in range(5)]
    entities = [(f"e{rng.randrange(40)}" if rng.random() < 0.9 else f"r{rng.randrange(6)}", rng.choice("PO"), rng.choice(stems) + rng.choice(["", "", "s", "n"]), k) for k in range(60)]
    # One id has one type and name, as ids are made of them.
    first: dict = {}
    entities = [(i, *first.setdefault(i, (t, n)), k) for i, t, n, k in entities]
    pairs = {(i, f) for i, *_ in entities for f in [f"r{k}" for k in range(5)] + [e[0] for e in entities] if rng.random() < 0.5}
    want, known = one_pass(entities, registry, pairs, 0.7)
    table = spark.createDataFrame(registry, "id string, name string, type string, aliases array<string>, ord long")
    asked = spark.createDataFrame(entities, "id string, type string, name string, ord long")
    resolved = resolve.disambiguate(asked, table, spark.createDataFrame(sorted(pairs), "entity string, found string")).persist()
    found = {r["ord"]: r["canonical"] for r in resolved.collect()}
    assert [found[e[3]] for e in entities] == [c for c, _ in want]
    grown = resolve.grown_registry(table.withColumn("sources", F.array().cast("array<string>")), resolved).orderBy("ord").collect()
    assert {r["id"]: (r["name"], list(r["aliases"])) for r in grown} == {i: (e["name"], e["aliases"]) for i, e in known.items()}
    assert [r["id"] for r in grown] == list(known)


@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.7, 0.9])
def test_similar_names_are_all_found(spark, threshold):
    from difflib import SequenceMatcher

    rng = random.Random(int(threshold * 10))
    names = ["".join(rng.choices("abcdé ", k=rng.randint(0, 25))) for _ in range(40)]
    edit = lambda n, i: n[:i] + rng.choice(["", "x", "Ab"]) + n[i + rng.randint(0, 2) :]
    names += [edit(edit(n, rng.randint(0, len(n))), rng.randint(0, len(n))) for n in names]
    left, right = [(k, rng.choice("PO"), n) for k, n in enumerate(names)], [(rng.choice("PO"), n, k) for k, n in enumerate(names)]
    wanted, owned = spark.createDataFrame(left, "key long, type string, wanted string"), spark.createDataFrame(right, "type string, own string, other long")
    found = {(r["key"], r["other"]): r["score"] for r in resolve.similar_names(wanted, owned, threshold).collect()}
    ratio = lambda a, b: SequenceMatcher(None, a.lower(), b.lower()).ratio()
    want = {(k, o): ratio(a, b) for k, t, a in left for u, b, o in right if t == u}
    assert found == {pair: r for pair, r in want.items() if r >= threshold}


def test_entities_of_one_name_are_no_pairs(spark, monkeypatch):
    rows = {}

    def counted(df, folder, name, inner=scratch.materialise):
        out = inner(df, folder, name)
        rows[name] = out.count()
        return out

    monkeypatch.setattr(scratch, "materialise", counted)
    asked = spark.createDataFrame([(f"e{k}", "P", "Johnson", k) for k in range(200)] + [("f", "P", "Johnsen", 200)], "id string, type string, name string, ord long")
    registry = spark.createDataFrame([("r", "Brown", "P", [], 0)], "id string, name string, type string, aliases array<string>, ord long")
    out = resolve.disambiguate(asked, registry, spark.createDataFrame([("f", "e0")], "entity string, found string"))
    steps = Counter((r["canonical"], r["step"]) for r in out.collect())
    assert steps == {("e0", "new"): 1, ("e0", "batch"): 199, ("e0", "fuzzy"): 1} and rows["alike"] == 2


# --- timeline --------------------------------------------------------------------------


def test_repeated_edges_of_a_date_are_no_pairs(spark):
    nodes = spark.createDataFrame([("e", "Event"), ("p", "Place"), *((f"d{k}", "Date") for k in range(50))], "id string, type string")
    edges = spark.createDataFrame([("e", "woo:relatedTo", f"d{k}", k) for k in range(50)] + [("e", "woo:occurredAt", "p", k) for k in range(400)], "subject string, predicate string, object string, ord int")
    found = timeline.date_links(nodes, edges)
    assert sorted(tuple(r) for r in found.collect()) == sorted([(f"d{k}", t, i, k) for k in range(50) for t, i in (("Event", "e"), ("Place", "p"))])
    most, below = 0, [found._jdf.queryExecution().executedPlan()]
    while below:
        plan = below.pop()
        kind = plan.getClass().getSimpleName()
        inner = plan.executedPlan() if kind == "AdaptiveSparkPlanExec" else plan.plan() if kind.endswith("QueryStageExec") else None
        below += [inner] if inner else [plan.children().apply(i) for i in range(plan.children().size())]
        rows = plan.metrics().get("numOutputRows")
        most = max(most, rows.get().value() if "Join" in kind and rows.isDefined() else 0)
    assert 0 < most <= 400


def test_dates_are_not_parsed_in_filters(spark):
    nodes = spark.range(3).select(F.concat(F.lit("d"), "id").alias("id"), F.lit("Date").alias("type"), F.concat(F.lit("May "), F.col("id") + 1998).alias("name"))
    edges = spark.createDataFrame([], "subject string, predicate string, object string, ord int")
    sources = spark.createDataFrame([], "source string, title string, type string, thumbnail string")
    items = timeline.date_items(nodes, edges, spark.createDataFrame([], "id string, source string, ord int"), sources)
    assert sorted(r["iso_start"] for r in items.collect()) == ["1998-05", "1999-05", "2000-05"]
    plan = items._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter" in line and "lambda" in line]


def test_keys_that_look_like_years_match_the_sql(spark, tmp_path):
    import duckdb

    customers = "SELECT r AS c_custkey, 'Customer ' || r AS c_name, (r % 25)::INT AS c_nationkey, 'S' || r % 5 AS c_mktsegment FROM range(1795, 1812) t(r)"
    orders = "SELECT r AS o_orderkey, 1795 + r % 17 AS o_custkey, TIMESTAMP '1995-01-01' + to_days((r * 7)::INT) AS o_orderdate FROM range(60) t(r)"
    con = duckdb.connect()
    for name, sql in (("customer", customers), ("orders", orders)):
        con.execute(f"COPY ({sql}) TO '{tmp_path}/{name}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE TABLE {name} AS {sql}")
    for name in ("timeline_spans", "timeline_items"):
        found = view_queries.QUERIES[name](spark, str(tmp_path))
        want = con.execute(f"SELECT {', '.join(found.columns)} FROM ({view_queries.ORACLES[name]})").fetchall()
        assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, want))


def test_visible_items_equal_a_scan(spark):
    rng = random.Random(8)
    rows = [(f"i{k}", "source" if k % 9 == 0 else "date", 1900 + rng.randrange(60), f"19{rng.randrange(60):02}-{rng.randint(1, 12):02}", "video" if k % 18 == 0 else "pdf", k, rng.random() < 0.5) for k in range(120)]
    laid = spark.createDataFrame(rows, "id string, type string, year int, iso_start string, source_type string, rank long, above boolean")
    for px in (10.0, 20.0, 30.0):
        got = {r["id"] for r in timeline.visible(laid, px).collect()}
        taken = {True: [], False: []}
        want = set()
        for i, kind, year, _, source_type, rank, above in sorted(rows, key=lambda r: (not (r[1] == "source" and r[4] == "video"), r[5])):
            always = kind == "source" and source_type == "video"
            if always or all(abs(p - year) >= 140 / px for p in taken[above]):
                want.add(i)
                taken[above].append(year)
        assert got == want
    assert [timeline.tick_interval(x) for x in (0.1, 1, 8, 60)] == [10, 50, 10, 1]


# --- detections --------------------------------------------------------------------------


def boxes(spark, rows):
    return spark.createDataFrame([("v", f, float(x), float(y), float(w), float(h), 0.5) for f, x, y, w, h in rows], detections.DETECTION_DDL)


def tracks(spark, rows, jump=50.0):
    found = detections.link_tracks(boxes(spark, rows), jump).groupBy("track").agg(F.count("*").alias("n")).collect()
    return sorted(r["n"] for r in found)


def test_tracks(spark):
    assert tracks(spark, [(i, 100 + i, 100, 20, 20) for i in range(20) if i not in (7, 8)]) == [18]
    assert tracks(spark, [(i, 100, 100, 20, 20) for i in range(50) if not 15 <= i < 35]) == [15, 15]
    assert tracks(spark, [(0, 100, 100, 6, 6), (1, 73, 73, 60, 60)]) == [1, 1]
    assert tracks(spark, [(i, 100, y, 20, 20) for i in range(20) for y in (100, 250)]) == [20, 20]


def test_boxes_merge():
    merged = detections.union_boxes([(10, 10, 5, 4, 1.0), (17, 10, 4, 4, 1.0), (200, 200, 5, 5, 1.0)], 3)
    assert [b[:4] for b in merged] == [(10, 10, 11, 4), (200, 200, 5, 5)]
    assert merged[0][4] == pytest.approx(36 / 44)
    assert len(detections.union_boxes([(0, 0, 1, 1, 1.0), (3, 0, 1, 1, 1.0), (6, 0, 1, 1, 1.0)], 2)) == 1


def brute_union(boxes, distance):
    """Groups of boxes whose bounds come near each other, found again and again until none do."""
    groups = [[b] for b in boxes]
    bounds = lambda g: (min(b[0] for b in g), min(b[1] for b in g), max(b[0] + b[2] for b in g), max(b[1] + b[3] for b in g))
    changed = True
    while changed:
        changed = False
        for i in range(len(groups)):
            for j in range(i):
                a, b = bounds(groups[i]), bounds(groups[j])
                if math.hypot(max(0, max(a[0], b[0]) - min(a[2], b[2])), max(0, max(a[1], b[1]) - min(a[3], b[3]))) <= distance:
                    groups[j] += groups.pop(i)
                    changed = True
                    break
            if changed:
                break
    return sorted((x, y, r - x, b - y, sum(g[4] * g[2] * g[3] for g in own) / ((r - x) * (b - y))) for own in groups for x, y, r, b in [bounds(own)])


def test_boxes_merge_whatever_their_order():
    rng = random.Random(3)
    for _ in range(60):
        own = [(rng.randrange(60), rng.randrange(60), rng.randint(1, 9), rng.randint(1, 9), rng.random()) for _ in range(rng.randint(0, 14))]
        found, want = detections.union_boxes(own, 4), brute_union(own, 4)
        assert [f[:4] for f in found] == [w[:4] for w in want] and [f[4] for f in found] == pytest.approx([w[4] for w in want])


def brute_link(rows, jump, gap):
    """All pairs of a frame's boxes and living tracks in one list, taken from the nearest on."""
    tracks, out = [], []
    for frame in sorted({r[0] for r in rows}):
        own = [r for r in rows if r[0] == frame]
        alive = [k for k, t in enumerate(tracks) if frame - t[0] <= gap]
        near = []
        for n, (_, x, y, w, h) in enumerate(own):
            for k in alive:
                _, a, b, c, d = tracks[k]
                if 0.25 <= w * h / (c * d) <= 4 or w * h < 150 and c * d < 150:
                    near.append((math.dist((x + w / 2, y + h / 2), (a + c / 2, b + d / 2)), n, k))
        chosen = {}
        for distance, n, k in sorted(near):
            if distance <= jump and n not in chosen and k not in chosen.values():
                chosen[n] = k
        for n, r in enumerate(own):
            if n not in chosen:
                chosen[n] = len(tracks)
                tracks.append(r)
            tracks[chosen[n]] = r
            out.append(chosen[n])
    return out


def test_links_go_to_the_nearest_first():
    rng = random.Random(5)
    for _ in range(40):
        rows = sorted({(rng.randrange(12) * rng.choice([1, 3]), rng.randrange(80), rng.randrange(80), rng.choice([4, 9, 20, 40]), rng.choice([4, 9, 20, 40])) for _ in range(rng.randint(0, 60))})
        frames = np.array([r[0] for r in rows], np.int64)
        found = detections.link(frames, np.array([r[1:] for r in rows], float).reshape(-1, 4), 30, 4)
        assert found.tolist() == brute_link(rows, 30, 4)


def test_candidates_crops_and_best_frames(spark):
    rng = random.Random(1)
    rows = [(0, 10 * k, 0, 5, 5) for k in range(8)] + [(1, 0, 0, 40, 40), (1, 100, 0, 3, 3)]
    few = detections.frame_candidates(boxes(spark, rows), 4, 500, before=6, after=3).collect()
    assert sorted((r["frame"], r["x"]) for r in few) == [(0, 0.0), (0, 10.0), (0, 20.0), (1, 100.0)]
    crops = spark.createDataFrame([("t", 5.0, 7.0), ("t", 3.0, 9.0), ("u", 1.0, 1.0)], "track string, x double, y double")
    assert sorted((r["track"], r["dx"], r["dy"]) for r in detections.crop_offsets(crops).collect()) == [("t", 0.0, 2.0), ("t", 2.0, 0.0), ("u", 0.0, 0.0)]
    scores = [("t", f, rng.random()) for f in range(30)] + [("u", 0, 0.1), ("u", 1, 0.9)]
    top, around = detections.best_aligned(spark.createDataFrame(scores, "track string, frame int, ncc double"))
    best = max(scores[:30], key=lambda s: s[2])[1]
    low = max(0, min(best - 2, 25))
    assert sorted(r["frame"] for r in around.filter("track = 't'").collect()) == list(range(low, low + 5))
    assert top.filter("track = 't'").count() == 15 and around.filter("track = 'u'").count() == 2


def test_selection(spark):
    rows = [("v", f, x, 0.0, 10.0, 10.0, fill, t) for t, x, fill, frames in [("long", 0.0, 0.9, range(100)), ("shadow", 5.0, 0.8, range(50)), ("other", 300.0, 0.9, range(60)), ("brief", 600.0, 1.0, range(9)), ("faint", 900.0, 0.05, range(30))] for f in frames]
    tracked = spark.createDataFrame(rows, detections.DETECTION_DDL + ", track string")
    frames = spark.createDataFrame([("v", 100)], "video string, n_frames long")
    chosen = sorted(detections.select_tracks(tracked, frames, 20.0).collect(), key=lambda r: r["place"])
    assert [r["track"] for r in chosen] == ["long", "other"]


def test_filters(spark):
    specks = [(i, 23, 500, 4, 4) for i in range(40)]
    assert detections.filter_outliers(boxes(spark, specks), 1920, 1080).filter("kept").count() == 40
    rows = [(i, 500, 500, 40, 40) for i in range(20)] + [(20, 500, 500, 90, 90), (21, 2, 500, 40, 40)]
    kept = {r["frame"]: r["kept"] for r in detections.filter_outliers(boxes(spark, rows), 1920, 1080).collect()}
    assert [f for f, k in kept.items() if not k] in ([20, 21], [21, 20])
    path = [(i, 100 + 2 * i, 100, 20, 20) for i in range(30)]
    path[15] = (15, 600, 100, 20, 20)
    kept = {r["frame"] for r in detections.filter_trajectory(boxes(spark, path)).filter("kept").collect()}
    assert kept == set(range(30)) - {15}


def test_scenes(spark):
    cuts = {0, 20, 23, 60}
    frames = spark.createDataFrame([("v", i, 0.9 if i in cuts else 0.1) for i in range(100)], "video string, idx long, d double")
    found = sorted(detections.scenes(frames, F.col("d")).collect())
    assert [(r["start"], r["end"]) for r in found] == [(0, 23), (23, 60), (60, 100)]
    same = spark.createDataFrame([([1.0, 3.0], [1.0, 3.0]), ([1.0, 0.0], [0.0, 1.0])], "p array<double>, q array<double>")
    assert [round(r[0], 6) for r in same.select(detections.bhattacharyya(F.col("p"), F.col("q"))).collect()] == [0.0, 1.0]


# --- manifests -----------------------------------------------------------------------------


def test_submissions(spark, tmp_path):
    texts = {"ok": "source: {title: T, type: pdf, url: 'http://x', date_added: 2024-01-01, tags: [a], processing: {scale: 2}}", "bad": "source: [", "empty": " \n", "none": "x: 1", "lacks": "source: {title: '', type: index, date_added: '2024-01-01'}", "_schema": "a: 1"}
    for name, text in texts.items():
        (tmp_path / f"{name}.yaml").write_text(text)
    rows = manifests.read_submissions(spark, str(tmp_path))
    got = {r["slug"]: r for r in rows.withColumn("p", manifests.problems(F.col("source"), F.lit(False), F.lit(False))).collect()}
    assert set(got) == {"ok", "bad", "empty", "none", "lacks"}
    assert got["ok"]["p"] == [] and got["ok"]["source"]["tags"] == ["a"] and got["ok"]["source"]["processing"]["scale"] == 2
    assert got["empty"]["error"] == "Empty YAML file" and got["bad"]["error"].startswith("Invalid YAML") and got["none"]["error"]
    assert len(got["lacks"]["p"]) == 2


def test_metadata_and_noise_terms(spark, tmp_path):
    for folder, text in {"a": '{"source_slug": "sa", "title": "A"}', "b": '{"title": "B"}', "c": "{broken"}.items():
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "metadata.json").write_text(text)
    found = {r["slug"]: r["title"] for r in manifests.read_metadata(spark, str(tmp_path)).collect()}
    assert found == {"sa": "A", "b": "B"}
    (tmp_path / "terms.txt").write_text("# comment\n\n Foo \nbar\n")
    assert sorted(r["term"] for r in manifests.read_noise_terms(spark, str(tmp_path / "terms.txt")).collect()) == ["bar", "foo"]


def test_registry_round_trip(spark):
    text = '{"entities": {"b": {"name": "B", "type": "T", "aliases": ["x"], "sources": []}, "a": {"name": "A", "type": "T", "aliases": [], "sources": ["s"]}}}'
    rows = manifests.parse_registry(spark.createDataFrame([(text,), ("broken",)], "text string"))
    assert [(r["id"], r["ord"]) for r in sorted(rows.collect(), key=lambda r: r["ord"])] == [("b", 0), ("a", 1)]
    assert json.loads(manifests.registry_json(rows).orderBy("ord").head()["json"])["aliases"] == ["x"]


def test_completion_uses_the_cache(spark):
    requests = spark.createDataFrame([("known",), ("new",), ("fails",)], "prompt string")
    cache = manifests.cached(requests.filter("prompt = 'known'"), spark.createDataFrame([], "key string, value string"), "prompt").select("key", F.lit("cached").alias("value"))

    def complete(text):
        if text == "fails":
            raise RuntimeError(text)
        return text.upper()

    answered, grown = manifests.complete(requests, cache, complete, "prompt")
    assert {r["prompt"]: r["value"] for r in answered.collect()} == {"known": "cached", "new": "NEW", "fails": None}
    assert sorted(r["value"] for r in grown.collect()) == ["NEW", "cached"]


def test_each_request_is_made_once_and_kept(spark, tmp_path):
    requests = spark.createDataFrame([(i, f"prompt {i % 5}") for i in range(40)], "i int, prompt string").repartition(6)
    log = tmp_path / "calls"

    def complete(text):
        with log.open("a") as f:
            f.write(text + "\n")
        return text[::-1]

    answered, grown = manifests.complete(requests, spark.createDataFrame([], "key string, value string"), complete, "prompt")
    for _ in range(3):
        assert answered.filter("value = reverse(prompt)").count() == 40
    path = str(tmp_path / "cache")
    manifests.put(grown, path)
    manifests.put(grown, path)
    kept = spark.read.parquet(path)
    assert kept.count() == 5
    again, _ = manifests.complete(requests, kept, complete, "prompt")
    assert again.filter("value is not null").count() == 40
    assert sorted(log.read_text().split("\n")) == ["", *(f"prompt {i}" for i in range(5))]


def test_lookup_states(spark):
    df = spark.createDataFrame([(None,), ("null",), ('{"a": 1}',), ("[1]",), ("{oops",)], "e string")
    assert [r[0] for r in df.select(manifests.lookup_state(F.col("e"))).collect()] == ["none", "miss", "hit", "corrupt", "none"]


# --- sinks and streams -----------------------------------------------------------------------


def test_sinks(spark, merged, tmp_path):
    nodes, mentions, edges = merged
    path = str(tmp_path / "nodes")
    fragments.write_json_lines(fragments.node_json(graph.node_documents(nodes, mentions)), path)
    lines = [json.loads(r[0]) for r in spark.read.text(path).collect()]
    assert lines[0] == {"@id": "e:1", "@type": "Person", "name": "One", "aliases": [], "mentionedIn": ["source:a", "source:b"]}
    (line,) = [json.loads(r["json"]) for r in fragments.edge_json(edges).collect()]
    assert line["subject"] == {"@id": "e:1"} and line["confidence"] == 0.95


def test_stream_equals_batch_and_repeats_safely(spark, tmp_path):
    rng = random.Random(9)
    ddl = "subject string, predicate string, object string, confidence double, extracted_by string, source string, ord int"
    rows = [(rng.choice("abc"), "p", rng.choice("xyz"), rng.choice([0.1, 0.5, None]), f"m{i}", rng.choice(["s1", "s2", ""]), i) for i in range(80)]
    for k in range(8):
        spark.createDataFrame(rows[k * 10 : k * 10 + 10], ddl).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        incremental.stream_edges(incremental.new_files(spark, str(tmp_path / "in"), ddl), str(tmp_path / "state"), str(tmp_path / "check"), compact_after=3).awaitTermination()
    assert sorted(p.name for p in (tmp_path / "state").iterdir()) == ["batch=3", "batch=4", "batch=5", "batch=6", "batch=7", "upto=2", "upto=5"]
    batch = graph.merge_edges(spark.createDataFrame(rows, ddl))
    assert sorted(map(tuple, incremental.merged_so_far(spark, str(tmp_path / "state")).collect())) == sorted(map(tuple, batch.collect()))


def test_entry(spark, sf_dir):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_library_stands_without_its_optional_package():
    import subprocess
    import sys

    code = "import sys; sys.modules['docgraph.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; assert 'merge_nodes' in e.queries(); assert not any(n.startswith('op') or n == 'pipeline' for n in e.queries())"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).resolve().parent.parent)


# --- crawling, converting, processing, commands ----------------------------------------------


def test_pagination(spark):
    chain = [(f"p{i}", f"p{i + 1}") for i in range(50)] + [("p50", "p3"), ("q", "p1")]
    pages = spark.createDataFrame(chain, "url string, next string")
    assert {r["url"]: r["depth"] for r in crawl.pagination(pages, "p0").collect()} == {f"p{i}": i for i in range(51)}
    assert crawl.pagination(pages, "p0", 5).count() == 5
    assert [tuple(r) for r in crawl.pagination(pages, "unknown").collect()] == [("unknown", 0)]


def test_discover_index(spark):
    pages = spark.createDataFrame(
        [
            ("http://h/i", '<a href="/b">B</a><a href="/a">A</a><a href="/login">in</a><a href="http://o/x">o</a><a href="/i2">next</a>'),
            ("http://h/i2", '<a href="/a">again</a><a href="/c">C</a>'),
            ("http://h/z", '<a href="/never">N</a>'),
        ],
        "url string, html string",
    )
    found = [(r["url"], r["title"]) for r in crawl.discover_index(pages, "http://h/i").collect()]
    assert found == [("http://h/b", "B"), ("http://h/a", "A"), ("http://h/i2", "next"), ("http://h/c", "C")]
    assert crawl.discover_index(pages, "http://h/i", 2).count() == 2


def test_web_text(spark):
    page = "<html><head><title>T</title><style>x</style></head><body><nav>menu</nav><h2>Head &amp; more</h2><p>One <b>two</b> three.</p><ul><li>item</li></ul><script>no()</script></body></html>"
    assert convert.main_text(page) == "## Head & more\n\nOne two three.\n\n- item"
    assert convert.main_text(None) == ""
    row = convert.web_documents(spark.createDataFrame([("http://h", page)], "url string, html string")).head()
    assert row["text"].startswith("<!-- Source: http://h -->\n\n## Head")


def test_pdf_routing(spark):
    files = spark.createDataFrame([("a", bytearray(b"x" * 500)), ("b", bytearray(b"y")), ("c", bytearray(b"z"))], "path string, content binary")
    out = convert.pdf_documents(files, lambda b: (b.decode(), 1), lambda b: None if b == b"z" else "seen")
    assert {r["path"]: (r["text"], r["backend"]) for r in out.collect()} == {"a": ("x" * 500, "digital"), "b": ("seen", "scanned"), "c": ("z", "digital")}


def test_small_predicates(spark):
    urls = ["https://www.youtube.com/watch?v=1", "http://youtu.be/x", "https://example.org/youtube.com", None]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r[0] for r in df.select(convert.is_youtube(F.col("u"))).collect()] == [True, True, False, False]
    frames = spark.range(20).select(F.lit("v").alias("video"), F.col("id").alias("frame"))
    assert [r["frame"] for r in convert.sampled_frames(frames, 3, 4).collect()] == [0, 3, 6, 9]


def test_document_to_fragment(spark):
    text = "Ann Smith joined Acme Works in Paris. " * 3
    sources = spark.createDataFrame([("source:d", "A Day in Paris")], "source string, title string")
    documents = spark.createDataFrame([("source:d", text)], "source string, text string")
    found = [("Ann Smith", "PERSON"), ("Acme Works", "ORG"), ("Paris", "GPE"), ("Ann Smith", "PERSON"), ("in", "ORG")]
    mentions = [("source:d", n, label, text.index(n), text.index(n) + len(n)) for n, label in found]
    mentions = spark.createDataFrame(mentions, "source string, name string, label string, start int, end int")
    entities = process.entities_of(mentions)
    assert {r["name"]: r["mention_count"] for r in entities.collect()} == {"Ann Smith": 2, "Acme Works": 1, "Paris": 1}
    terms = spark.createDataFrame([("paris",)], "term string")
    assert process.entities_of(mentions, terms).count() == 2
    assert process.snippets(mentions, documents).filter(F.contains("snippet", F.col("name"))).count() == 5
    chunks = process.chunks_with_entities(documents, entities)
    assert [r["names"] for r in chunks.collect()] == [["Acme Works", "Ann Smith", "Paris"]]

    def reply(prompt):
        assert "Ann Smith" in prompt and "member_of" in prompt
        return '[{"subject": "Ann Smith", "predicate": "member_of", "object": "acme works", "confidence": 0.8}, {"subject": "Nobody", "predicate": "founded", "object": "Paris"}]'

    extracted, grown = process.relationships(chunks, entities, spark.createDataFrame([], "key string, value string"), reply, "model:x")
    assert [tuple(r) for r in extracted.collect()] == [("source:d", "entity:person-ann-smith", "member_of", "entity:organization-acme-works", 0.8, "model:x")]
    assert grown.count() == 1
    nodes, edges = process.fragments(sources, entities, extracted)
    assert nodes.count() == 4
    (document,) = publish.fragment_documents(nodes, edges).collect()
    data = json.loads(document["json"])
    assert document["slug"] == "d" and data["@id"] == "source:d" and data["@context"] == "../context.jsonld"
    assert data["entities"][0] == {"@id": "source:d", "@type": "woo:Source", "name": "A Day in Paris"}
    assert {e["@id"]: e.get("mentionedIn") for e in data["entities"][1:]} == {f"entity:{x}": "source:d" for x in ("person-ann-smith", "organization-acme-works", "place-paris")}
    assert len(data["relationships"]) == edges.count()
    assert {(r["subject"], r["predicate"]) for r in edges.filter("predicate <> 'woo:mentionedIn'").collect()} == {("entity:person-ann-smith", "woo:memberOf")}


def test_commands(spark, tmp_path, capsys):
    a = {"@id": "source:a", "entities": [{"@id": "source:a", "@type": "woo:Source", "name": "A"}, {"@id": "e:1", "@type": "Person", "name": "Person One", "mentionedIn": "source:a"}, {"@id": "e:2", "@type": "Place", "name": "Place Two", "mentionedIn": "source:a"}, {"@id": "e:3", "@type": "Date", "name": "June 1942", "mentionedIn": "source:a"}, {"@id": "e:4", "@type": "Place", "name": "ab"}], "relationships": [edge("e:1", "woo:bornIn", "e:2", 0.7), edge("e:1", "woo:occurredAt", "e:3", 0.4), edge("e:2", "woo:relatedTo", "e:4")]}
    write(tmp_path / "f", a=a)
    (tmp_path / "meta").mkdir()
    (tmp_path / "meta" / "metadata.json").write_text('{"source_slug": "x-1999-y", "title": "X"}')
    t = str(tmp_path)
    assert cli.main(["merge", "--fragments", f"{t}/f", "--out", f"{t}/g"]) == 0
    assert cli.main(["clean", "--graph", f"{t}/g", "--out", f"{t}/c"]) == 0
    assert sorted(r["id"] for r in spark.read.parquet(f"{t}/c/nodes").collect()) == ["e:1", "e:2", "e:3", "source:a"]
    capsys.readouterr()
    cli.main(["report", "--fragment", f"{t}/f", "--title", "T"])
    out = capsys.readouterr().out
    assert "### T\n- **Entities**: 4 (2 Place, 1 Person, 1 Date)\n- **Relationships**: 3" in out and "1 -> bornIn -> 2 (0.70)" in out and "1 low-confidence" in out
    cli.main(["graph-preview", "--fragment", f"{t}/f"])
    assert '    e_1["👤 Person One"]\n' in capsys.readouterr().out
    spark.createDataFrame([("e:2",)], "id string").write.parquet(f"{t}/v")
    cli.main(["llm-clean", "--graph", f"{t}/c", "--verdicts", f"{t}/v", "--out", f"{t}/l"])
    assert spark.read.parquet(f"{t}/l/edges").count() == 1
    spark.createDataFrame([("Place Two", 1.0, 2.0, 0.5, 0)], "place_name string, lat double, lng double, confidence double, ord int").write.parquet(f"{t}/k")
    cli.main(["geocode", "--graph", f"{t}/c", "--candidates", f"{t}/k", "--out", f"{t}/geo"])
    assert spark.read.parquet(f"{t}/geo").head()["lat"] == 1.0
    cli.main(["timeline", "--graph", f"{t}/c", "--metadata", f"{t}/meta", "--out", f"{t}/t"])
    assert {r["id"]: r["year"] for r in spark.read.parquet(f"{t}/t").collect()} == {"e:3": 1942, "source:x-1999-y": 1999}
    cli.main(["export", "--graph", f"{t}/c", "--out", f"{t}/x"])
    assert spark.read.text(f"{t}/x/entities").count() == 4
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "bad.yaml").write_text("source: {type: url}")
    assert cli.main(["validate", "--submissions", f"{t}/s"]) == 1


# --- publishing, media, services --------------------------------------------------------


def test_documents(spark, merged, tmp_path):
    nodes, mentions, edges = merged
    parts = graph.node_documents(nodes, mentions, 1).filter("id = 'e:1'").orderBy("part").collect()
    assert [(r["part"], r["mentioned_in"]) for r in parts] == [(0, ["source:a"]), (1, ["source:b"])]
    publish.write_global({"name": "x"}, graph.node_documents(nodes, mentions), edges, str(tmp_path / "g"))
    assert fragments.read_context(spark, str(tmp_path / "g" / "context")) == {"name": "x"}
    (line,) = publish.graph_statistics(graph.stats(nodes, edges, mentions), graph.type_counts(nodes), "now").collect()
    assert json.loads(line[0]) == {"total_entities": 2, "total_relationships": 1, "total_sources": 2, "entities_by_type": {"Person": 1, "Place": 1}, "last_updated": "now"}
    items = spark.createDataFrame([("b", 1950, "1950", "year"), ("a", None, None, None), ("c", 1940, "1940-05", "month")], "id string, year int, iso_start string, precision string")
    header, lines = publish.timeline_document(items, timeline.spans(items), "now")
    document = json.loads(publish.one_document(header.head()[0], {"items": lines}))
    assert document["spans"] == {"min_year": 1940, "max_year": 1950, "total_items": 3, "by_precision": {"month": 1, "unknown": 1, "year": 1}}
    assert [i["id"] for i in document["items"]] == ["c", "b", "a"]
    results = spark.createDataFrame([("p", "P", 1.0, 2.0, 0.5, None), ("q", "Q", None, None, None, "no_results")], "id string, name string, lat double, lng double, confidence double, reason string")
    header, places, failures = publish.geocoded_document(results, "now")
    assert json.loads(header.head()[0])["stats"] == {"total": 2, "geocoded": 1, "failed": 1}
    assert [json.loads(r["json"])["id"] for r in places.union(failures).collect()] == ["p", "q"]


def test_source_files(spark, tmp_path):
    sources = spark.createDataFrame([("s1", "T", "pdf", None, "2024-01-01", None, None)], "slug string, title string, type string, author string, date_added string, tags array<string>, description string")
    publish.write_source_files(sources, spark.createDataFrame([("s1", "# A\n\ntext")], "slug string, text string"), str(tmp_path / "out"), "now")
    found = {r["file"]: r["value"] for r in spark.read.text(str(tmp_path / "out"), wholetext=True).collect()}
    assert found["content.md"].strip() == "# A\n\ntext" and json.loads(found["metadata.json"])["source_slug"] == "s1"
    publish.write_fragment_documents(spark.createDataFrame([("s1", "{}"), ("s2", "{}")], "slug string, json string"), str(tmp_path / "f"))
    publish.write_fragment_documents(spark.createDataFrame([("s2", "[]")], "slug string, json string"), str(tmp_path / "f"))
    assert {r["slug"]: r["value"] for r in spark.read.text(str(tmp_path / "f")).collect()} == {"s1": "{}", "s2": "[]"}


def test_registry_file(spark, tmp_path):
    rows = spark.createDataFrame([("b", "B", "T", ["x"], None, 0), ("a", "A", "T", None, ["s"], 1)], "id string, name string, type string, aliases array<string>, sources array<string>, ord long")
    manifests.save_registry(rows, str(tmp_path / "r"))
    back = manifests.parse_registry(spark.read.text(str(tmp_path / "r"), wholetext=True).withColumnRenamed("value", "text"))
    assert [tuple(r) for r in back.orderBy("ord").collect()] == [("b", "B", "T", ["x"], [], 0), ("a", "A", "T", [], ["s"], 1)]


def jpeg(order, refs=(b"S", b"E")):
    """A JPEG file that is nothing but a comment and EXIF data with a position."""
    pack = lambda form, *v: __import__("struct").pack(order + form, *v)
    entry = lambda tag, kind, n, value: pack("HHI", tag, kind, n) + value.ljust(4, b"\0")
    gps_at, data_at = 8 + 2 + 12 + 4, 8 + 2 + 12 + 4 + 2 + 48 + 4
    gps = pack("H", 4) + entry(1, 2, 2, refs[0]) + entry(2, 5, 3, pack("I", data_at)) + entry(3, 2, 2, refs[1]) + entry(4, 5, 3, pack("I", data_at + 24)) + pack("I", 0)
    values = pack("6I", 41, 1, 30, 1, 36, 1) + pack("6I", 2, 1, 0, 1, 9, 0)
    tiff = (b"MM" if order == ">" else b"II") + pack("HI", 42, 8) + pack("H", 1) + entry(0x8825, 4, 1, pack("I", gps_at)) + pack("I", 0) + gps + values
    body = b"Exif\0\0" + tiff
    return b"\xff\xd8\xff\xfe\x00\x06abcd\xff\xe1" + (len(body) + 2).to_bytes(2, "big") + body + b"\xff\xd9"


def test_positions_of_images(spark):
    for order in "<>":
        assert convert.gps_of(jpeg(order)) == pytest.approx((-41.51, 2.0))
    good = jpeg(">", (b"N", b"W"))
    assert convert.gps_of(good) == pytest.approx((41.51, -2.0))
    for bad in (None, b"", b"no image", good[:40], good[:-30], b"\xff\xd8\xff\xd9", good.replace(b"MM", b"XX")):
        assert convert.gps_of(bad) is None
    rows = spark.createDataFrame([(bytearray(good),), (bytearray(b"x"),)], "content binary").select(convert.image_gps(F.col("content")).alias("g")).collect()
    assert rows[0]["g"]["lng"] == pytest.approx(-2.0) and rows[1]["g"]["lat"] is None


def test_archive_fallback(spark):
    pages = spark.createDataFrame([("a", None), ("b", "<p>here</p>"), ("c", ""), ("d", None)], "url string, html string")
    archived = spark.createDataFrame([("a", "<p>old</p>", 1), ("a", "<p>new</p>", 2), ("b", "<p>copy</p>", 1), ("c", "<p>kept</p>", 1)], "url string, html string, taken int")
    found = {r["url"]: (r["html"], r["archived"]) for r in convert.with_archive(pages, archived).collect()}
    assert found == {"a": ("<p>new</p>", True), "b": ("<p>here</p>", False), "c": ("<p>kept</p>", True), "d": (None, False)}


def test_services():
    one, two = providers.Service("one", ("ONE_KEY",), "m1"), providers.Service("two", ("TWO_KEY", "TWO_ALT"), "m2", "http://two")
    choose = lambda **s: providers.choose([one, two], s)
    assert choose() is None and choose(LLM_PROVIDER="one") is None
    assert choose(TWO_ALT="k") == providers.Chosen("two", "m2", "k", "http://two", 0.0)
    assert choose(TWO_KEY="k", ONE_KEY="o").service == "one"
    assert choose(LLM_API_KEY="g", TWO_KEY="k") == providers.Chosen("one", "m1", "g", None, 0.0)
    assert choose(LLM_PROVIDER="Two", ONE_KEY="o", LLM_MODEL="x", LLM_TEMPERATURE="0.5") == providers.Chosen("two", "x", "o", "http://two", 0.5)
    calls = []

    def flaky(prompt):
        calls.append(prompt)
        if len(calls) < 2:
            raise RuntimeError(prompt)
        return "ok"

    assert providers.retrying(flaky, 1, 0)("p") == "ok"
    calls.clear()
    with pytest.raises(RuntimeError):
        providers.retrying(flaky, 0, 0)("p")


def test_small_media_tables(spark):
    files = spark.createDataFrame([("s", "a.b.png", "u1"), ("s", "c.mp4", "u2")], "slug string, name string, url string")
    assert publish.upload_map(files).head()["urls"] == {"a.b": "u1", "c": "u2"}
    videos = spark.createDataFrame([("s", "T", 9, [(1, 5, 0.25)]), ("e", "E", 0, [])], "slug string, title string, frames int, tracks array<struct<track: int, detections: int, score: double>>")
    texts = {r["slug"]: r["text"] for r in publish.video_summary(videos).collect()}
    assert texts["s"].endswith("- **Object 1**: 5 detections, score 0.250\n") and "No objects" in texts["e"]


def test_scratch_is_cleared_and_shared(spark, monkeypatch):
    folder = scratch.new_folder(spark, "t")
    table = scratch.bucketed(spark.range(5), folder, "b", 2, "id")
    assert table.count() == 5
    kept, tables = dict(scratch._FOLDERS), dict(scratch._TABLES)
    app = spark.sparkContext.applicationId
    monkeypatch.setattr(scratch, "_FOLDERS", {app: [folder]})
    monkeypatch.setattr(scratch, "_TABLES", {app: [tables[app][-1]]})
    scratch.clear(spark)
    assert not Path(folder.removeprefix("file://")).exists() and not spark.catalog.tableExists(tables[app][-1])
    assert kept[app][-1] == folder
    assert [scratch.on_one_machine(m) for m in ("local", "local[*]", "local[4,2]", "local-cluster[2,1,1024]", "spark://host:7077", "yarn")] == [True] * 3 + [False] * 3
