"""Index pages: following pagination and listing the pages that they link to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docgraph.functions import markup
from docgraph.sources import scratch


def pagination(pages: DataFrame, start: str, most: int = 5000) -> DataFrame:
    """url, depth of ``start`` and the pages that follow it, each at its first place.

    ``pages`` (url, next). Successors are squared every round: after k rounds all pages
    within 2**k steps are known, so rounds grow with the logarithm of the chain.
    """
    folder = scratch.new_folder(pages.sparkSession, "pagination")
    jump = pages.filter("next is not null").groupBy("url").agg(F.min("next").alias("next"))
    reached = pages.sparkSession.createDataFrame([(start, 0)], "url string, depth long")
    step = 1
    while step <= most:
        ahead = reached.join(jump, "url").select(F.col("next").alias("url"), (F.col("depth") + step).alias("depth"))
        grown = reached.union(ahead).groupBy("url").agg(F.min("depth").alias("depth")).filter(F.col("depth") < most)
        grown = scratch.materialise(grown, folder, f"reached_{step}")
        if grown.count() == reached.count():
            break
        twice = jump.select("url", F.col("next").alias("mid")).join(jump.select(F.col("url").alias("mid"), "next"), "mid").select("url", "next")
        jump, reached, step = scratch.materialise(twice, folder, f"jump_{step}"), grown, step * 2
    return reached


def discover_index(pages: DataFrame, start: str, max_pages: int = 5000) -> DataFrame:
    """url, title, ord of content pages linked from an index and its following pages, at most ``max_pages`` in order.

    ``pages`` (url, html) holds what has been fetched.
    """
    followed = pages.withColumn("next", markup.next_page(F.col("html"), F.col("url")))
    chain = pagination(followed.select("url", "next"), start, max_pages)
    links = pages.join(chain, "url").select(F.col("url").alias("base"), "depth", F.posexplode(markup.page_links(F.col("html"), F.col("url"))).alias("pos", "link"))
    host = F.try_parse_url("base", F.lit("AUTHORITY"))
    content = links.filter(markup.is_content_url(F.col("link.url"), host))
    first = content.groupBy("link.url").agg(F.min(F.struct("depth", "pos", "link.title")).alias("f"))
    return first.select("url", "f.title", F.struct("f.depth", "f.pos").alias("ord")).orderBy("ord").limit(max_pages)
