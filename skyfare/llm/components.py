"""Distributed connected components of an undirected graph.

Alternating star contraction: each node's larger neighbours move to its least
neighbour, then its smaller ones do, until only stars are left. Every round is
grouped minima (combined before the shuffle) and equi-joins, and is written to
the shared folder, so neither links nor components reach the driver and a lost
executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfare.llm.common import discard, staged, tidy

MAX_ROUNDS = 60


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("lo").alias("hi"), F.col("hi").alias("lo"))).toDF("u", "v")
    least = both.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
    return (both.join(least, F.col("u") == F.col("w")).filter(F.col("v") > F.col("u"))
            .select(F.col("v").alias("hi"), F.least("m", "u").alias("lo")).distinct())


def _small_star(e: DataFrame) -> DataFrame:
    least = e.groupBy(F.col("hi").alias("w")).agg(F.min("lo").alias("m"))
    moved = (e.join(least, F.col("hi") == F.col("w")).filter(F.col("lo") != F.col("m"))
             .select(F.col("lo").alias("hi"), F.col("m").alias("lo")))
    return moved.union(least.select(F.col("w").alias("hi"), F.col("m").alias("lo"))).distinct()


def _mark(e: DataFrame):
    return e.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): each node that has a link, with the least node that
    links reach from it. Self-links, repeated links and NULL ends are ignored;
    no links give no rows."""
    e = staged(links.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
               .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("hi") != F.col("lo")))
               .distinct(), "links")
    before = _mark(e)
    for _ in range(MAX_ROUNDS):
        if not before[0]:
            break
        # Written, as the second half reads it three times.
        moved = staged(_large_star(e), "large-stars")
        discard(e)
        e = staged(_small_star(moved), "stars")
        discard(moved)
        after = _mark(e)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("connected components did not settle")
    tidy(links.sparkSession)
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(
        e.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())
