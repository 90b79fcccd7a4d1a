"""A rank over a whole table without gathering it in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgraph.sources import scratch


def global_rank(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """``df`` with its row's place from 0 in the total order ``order``.

    The sort is range-partitioned; each partition numbers its own rows, and the
    partitions' sizes, one number each, give the offsets.
    """
    own = F.monotonically_increasing_id()
    placed = df.orderBy(*order).select("*", own.bitwiseAND((1 << 33) - 1).alias("__row"), F.shiftrightunsigned(own, 33).alias("__part"))
    placed = scratch.materialise(placed, scratch.new_folder(df.sparkSession, "rank"), "sorted")
    sizes = {r["__part"]: r["count"] for r in placed.groupBy("__part").count().collect()}
    offsets, total = [], 0
    for part in sorted(sizes):
        offsets.append((part, total))
        total += sizes[part]
    starts = df.sparkSession.createDataFrame(offsets, "__part long, __start long")
    return placed.join(F.broadcast(starts), "__part").withColumn(name, F.col("__start") + F.col("__row")).drop("__part", "__row", "__start")


def rank_within(df: DataFrame, within: list[str], order: list[Column], name: str = "rank") -> DataFrame:
    """``df`` with its row's place from 0 in the order ``order`` among the rows that share ``within``.

    It is the rank over everything less the rank at which the key begins, so that a
    common key is no one task's. Null keys are alike.
    """
    ranked = global_rank(df, [*(F.col(w) for w in within), *order], "__at")
    ranked = scratch.materialise(ranked, scratch.new_folder(df.sparkSession, "rank"), "placed")
    begins = ranked.groupBy(*(F.col(w).alias(f"__{w}") for w in within)).agg(F.min("__at").alias("__begin"))
    same = [F.col(w).eqNullSafe(F.col(f"__{w}")) for w in within]
    joined = ranked.join(begins, same).withColumn(name, F.col("__at") - F.col("__begin"))
    return joined.drop("__at", "__begin", *(f"__{w}" for w in within))
