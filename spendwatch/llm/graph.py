"""Connected components over an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendwatch.llm.common import stage

SALTS = 8


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction of edges (hi > lo).

    Large star: every neighbour greater than the node moves to the node's least
    neighbour.  Small star: every smaller neighbour, and the node, moves there.
    """
    lo, hi = F.col("lo"), F.col("hi")
    if large:
        sides = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(
            edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    else:
        sides = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
    least = sides.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    # A node with very many neighbours is dealt over SALTS tasks; the spread
    # side grows with the nodes, so it is never broadcast.
    spread = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    moved = sides.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")).join(
        spread.hint("merge"), ["u", "salt"])
    if large:
        moved = moved.where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
    else:
        moved = moved.where("v <> m").select(F.col("v").alias("hi"), F.col("m").alias("lo")).unionAll(
            least.select(F.col("u").alias("hi"), F.col("m").alias("lo")))
    return moved.where(hi > lo).distinct()


def components(edges: DataFrame, name: str) -> DataFrame:
    """(id, component) for every id on an edge (a, b); the component is its least id.

    Each round is written to the shared folder, so no round recomputes the one
    before.  The fixed point (every edge joins an id with its component) is
    reached after O(log^2) rounds; the check reads two numbers.
    """
    e = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(),
              f"{name}-edges")
    while True:
        e = stage(_star(_star(e, large=True), large=False), f"{name}-round")
        # Done when no id is both a child and a parent, and no child has two parents.
        seen = e.select(F.col("hi").alias("id"), F.lit(1).alias("c"), F.lit(0).alias("p")).unionAll(
            e.select(F.col("lo").alias("id"), F.lit(0).alias("c"), F.lit(1).alias("p")))
        state = seen.groupBy("id").agg(F.sum("c").alias("c"), F.max("p").alias("p"))
        if state.where("c > 1 or (c = 1 and p = 1)").limit(1).count() == 0:
            break
    return e.select(F.col("hi").alias("id"), F.col("lo").alias("component")).unionAll(
        e.select(F.col("lo").alias("id"), F.col("lo").alias("component")).distinct())
