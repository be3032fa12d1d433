"""Connected components of a distributed edge list by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import cut


def _checksum(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


ROWS_A_TASK = 200_000


def components(edges: DataFrame) -> DataFrame:
    """(a, b) links → (node, component): the smallest node reachable, for every node that has a link. Each round
    hangs every node's larger neighbours, then its smaller ones, under its smallest neighbour (both keep the
    components and shorten the paths); rounds stop when nothing changes. Neighbour minima are aggregations with
    map-side combining, so a hub of any degree is no single task's work. Tasks follow the number of links left."""
    e = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct())
    last = _checksum(e)
    while True:
        tasks = max(1, -(-last[0] // ROWS_A_TASK))
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).coalesce(tasks)
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a != b").coalesce(tasks).distinct().coalesce(tasks))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").select(F.col("b").alias("x"), "m")
                 .unionByName(least.select(F.col("a").alias("x"), "m"))
                 .select(F.greatest("x", "m").alias("a"), F.least("x", "m").alias("b")).where("a != b")
                 .coalesce(tasks).distinct())
        e = cut(small.coalesce(tasks))
        now = _checksum(e)
        if now == last:
            break
        last = now
    return (e.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()))
