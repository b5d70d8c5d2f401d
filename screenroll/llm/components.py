"""Connected components of a link table by alternating large and small stars, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage

MAX_ROUNDS = 60


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).collect()[0])


def _to_least(rows: DataFrame, larger_only: bool) -> DataFrame:
    """Each neighbour ``b`` of ``a`` is linked to the least of a's star instead."""
    least = rows.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    linked = rows.join(least, "a")
    if larger_only:
        linked = linked.where("b > a")
    return linked.where("b != low").select(F.col("b").alias("a"), F.col("low").alias("b"))


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the least node reachable) of every node in ``links`` (a, b).

    Works on any sortable ids; loops, repeated and reversed links and NULL ends do no harm (links
    with a NULL end are left out). Each round is a few joins and aggregates and is stored, so no
    lineage builds up; the number of rounds grows with the logarithm of the longest path.
    """
    edges = stage(
        links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "components")
    mark = _mark(edges)
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _to_least(both, larger_only=True).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(least, "a")
        small = small.where("b != low").select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            least.select("a", F.col("low").alias("b"))).distinct()
        edges = stage(small, "components")
        last, mark = mark, _mark(edges)
        if last == mark:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
    raise RuntimeError("components did not settle")
