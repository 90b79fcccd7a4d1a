"""Commands over folders of Parquet tables: ``python -m docgraph COMMAND --help``."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docgraph.functions import names, noise
from docgraph.functions.markup import two_places
from docgraph.operators import crawl, graph, resolve, timeline, views
from docgraph.sources import fragments, manifests, publish, scratch

TABLES = ("nodes", "mentions", "edges")


def load(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(spark.read.parquet(f"{folder}/{t}") for t in TABLES)


def save(folder: str, *tables: DataFrame) -> None:
    """Write nodes, mentions and edges; ``folder`` must not be one that they are read from."""
    for name, df in zip(TABLES, tables, strict=True):
        df.write.mode("overwrite").parquet(f"{folder}/{name}")


def one_fragment(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    nodes, _, edges = fragments.fragment_tables(fragments.read_fragments(spark, path))
    return nodes, edges


def report_lines(nodes: DataFrame, edges: DataFrame, title: str) -> list[str]:
    """A markdown report on one fragment; what comes to the driver are a few rows."""
    counts = views.report_counts(nodes, edges).head()
    known = nodes.filter(F.coalesce("type", F.lit("unknown")) != names.SOURCE_TYPE)
    types = known.groupBy(F.coalesce("type", F.lit("unknown")).alias("type")).agg(F.count("*").alias("n"), F.min("ord").alias("first")).orderBy(F.desc("n"), "first").collect()
    lines = [f"### {title}", f"- **Entities**: {counts['entities']} ({', '.join(f'{r["n"]} {r["type"]}' for r in types) or 'none'})", f"- **Relationships**: {counts['relationships']}"]
    top = views.name_counts(nodes, []).collect()
    if top:
        lines.append("- **Top entities**: " + ", ".join(f"{r['name']} ({r['node_count']})" for r in top))
    tail = F.element_at(F.split("predicate", ":"), -1)
    sample = views.sample_relationships(edges).select(names.pretty_id(F.col("subject")).alias("s"), tail.alias("p"), names.pretty_id(F.col("object")).alias("o"), two_places(F.coalesce("confidence", F.lit(0.0))).alias("c")).collect()
    if sample:
        lines.append("- **Sample relationships**:")
        lines += [f"  - {r['s']} -> {r['p']} -> {r['o']} ({r['c']})" for r in sample]
    if counts["low_confidence"]:
        lines.append(f"- **Warning**: {counts['low_confidence']} low-confidence relationships (<0.5)")
    return lines


def run(spark: SparkSession, a: argparse.Namespace) -> int:
    if a.command == "validate":
        rows = manifests.read_submissions(spark, a.submissions)
        names_ = spark.read.format("binaryFile").load(a.files).select(F.element_at(F.split("path", "/"), -1).alias("there")).distinct() if a.files else spark.createDataFrame([], "there string")
        joined = rows.join(names_, F.col("source.file") == F.col("there"), "left")
        found = joined.select("slug", F.coalesce(F.when(F.col("error").isNotNull(), F.array("error")), manifests.problems(F.col("source"), F.col("there").isNotNull(), F.lit(True))).alias("problems")).filter(F.size("problems") > 0)
        n = 0
        for n, r in enumerate(found.orderBy("slug").toLocalIterator(), 1):  # a partition at a time  # noqa: B007
            print(f"{r['slug']}: {'; '.join(r['problems'])}")
        return int(n > 0)
    if a.command == "merge":
        nodes, mentions, edges = fragments.fragment_tables(fragments.read_fragments(spark, a.fragments))
        save(a.out, graph.merge_nodes(nodes), graph.merge_mentions(mentions), graph.merge_edges(edges))
        print(graph.stats(*(spark.read.parquet(f"{a.out}/{t}") for t in ("nodes", "edges", "mentions"))).head().asDict())
    elif a.command == "report":
        print("\n".join(report_lines(*one_fragment(spark, a.fragment), a.title or a.fragment)))
    elif a.command == "graph-preview":
        lines = views.mermaid(*one_fragment(spark, a.fragment), a.max_nodes, a.min_confidence).orderBy("section", "ord").collect()
        print("\n".join(["```mermaid", "graph LR", *(r["line"] for r in lines), "```"]) if lines else "No relationships to render.")
    elif a.command == "discover-index":
        plan = crawl.discover_index(spark.read.parquet(a.pages), a.start, a.max_pages)
        plan.write.mode("overwrite").json(a.out)
    else:
        nodes, mentions, edges = load(spark, a.graph)
        if a.command == "clean":
            kept, edges, merged = graph.clean(nodes, edges)
            save(a.out, kept, graph.moved_mentions(mentions, merged).join(kept.select("id"), "id", "left_semi"), edges)
        elif a.command == "suspects":
            nodes.filter((F.col("type") != names.SOURCE_TYPE) & noise.is_suspicious(F.col("name"))).write.mode("overwrite").parquet(a.out)
        elif a.command in ("llm-clean", "llm-clean-places"):
            removed = spark.read.parquet(a.verdicts)
            kept, edges = graph.apply_removals(nodes, edges, removed)
            save(a.out, kept, mentions.join(removed.select("id"), "id", "left_anti"), edges)
        elif a.command == "merge-people":
            groups, not_people = graph.people_verdicts(graph.people_groups(nodes), spark.read.parquet(a.replies))
            initials = nodes.filter((F.col("type") == "Person") & noise.is_initials(F.col("name")))
            kept, edges = graph.apply_groups(nodes, edges, groups, not_people.union(initials.select("id")))
            save(a.out, kept, mentions.join(kept.select("id"), "id", "left_semi"), edges)
        elif a.command == "merge-orgs":
            orgs = graph.batches(nodes.filter("type = 'Organization'").withColumn("all", F.lit(0)), [F.col("ord")], a.size, ["all"])
            groups, not_orgs = graph.org_verdicts(orgs, spark.read.parquet(a.replies))
            kept, edges = graph.apply_groups(nodes, edges, groups, not_orgs)
            save(a.out, kept, mentions.join(kept.select("id"), "id", "left_semi"), edges)
        elif a.command == "geocode":
            places = nodes.filter(F.col("type").isin(noise.PLACE_TYPES) & (F.col("name") != "")).select("id", "name")
            none = spark.createDataFrame([], "place_name string, reply string"), spark.createDataFrame([], "id string, cached string")
            replies = spark.read.parquet(a.replies) if a.replies else none[0]
            misses = spark.read.parquet(a.misses) if a.misses else none[1]
            geocoded = scratch.materialise(resolve.geocode(places, spark.read.parquet(a.candidates), replies, misses), scratch.new_folder(spark, "geocode"), "results")
            for r in publish.geocode_counts(geocoded).orderBy("reason").collect():
                print(f"{r['reason']}: {r['n']}")
            if not a.dry_run:
                geocoded.write.mode("overwrite").parquet(a.out)
        elif a.command == "timeline":
            about = manifests.read_metadata(spark, a.metadata)
            sources = about.select(F.concat(F.lit("source:"), "slug").alias("source"), "slug", "title", "type", F.lit(None).cast("string").alias("thumbnail"), "date_added")
            timeline.timeline(nodes, edges, mentions, sources).orderBy(F.coalesce("year", F.lit(9999)), "iso_start", "id").write.mode("overwrite").parquet(a.out)
        elif a.command == "export":
            fragments.write_json_lines(fragments.node_json(graph.node_documents(nodes, mentions)), f"{a.out}/entities")
            fragments.write_json_lines(fragments.edge_json(edges), f"{a.out}/relationships")
    return 0


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="docgraph", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, what: str, *required: str, **optional) -> None:
        sub = commands.add_parser(name, help=what)
        for r in required:
            sub.add_argument(f"--{r}", required=True)
        for o, default in optional.items():
            sub.add_argument(f"--{o.replace('_', '-')}", default=default, type=type(default) if default is not None else str)

    command("validate", "check submission manifests", "submissions", files=None)
    command("merge", "merge fragments into a graph", "fragments", "out")
    command("report", "markdown report on a fragment", "fragment", title=None)
    command("graph-preview", "Mermaid diagram of a fragment", "fragment", max_nodes=25, min_confidence=0.5)
    command("discover-index", "content pages linked from an index", "pages", "start", "out", max_pages=5000)
    command("clean", "drop noise, merge names, drop orphans", "graph", "out")
    command("suspects", "nodes that a verdict should be asked for", "graph", "out")
    for name in ("llm-clean", "llm-clean-places"):
        command(name, "remove the nodes of a verdict table (id)", "graph", "verdicts", "out")
    command("merge-people", "merge people by replies (surname, reply) about those who share a surname", "graph", "replies", "out")
    command("merge-orgs", "merge organizations by replies (batch, reply) about batches of them", "graph", "replies", "out", size=60)
    command("geocode", "coordinates of places from candidates, or with a dry run only their counts", "graph", "candidates", "out", replies=None, misses=None, dry_run=0)
    command("timeline", "timeline items", "graph", "metadata", "out")
    command("export", "JSON lines of nodes and edges", "graph", "out")
    return parser


def main(argv: list[str] | None = None) -> int:
    a = arguments().parse_args(argv)
    return run(SparkSession.builder.appName("docgraph").getOrCreate(), a)


if __name__ == "__main__":
    sys.exit(main())
