"""Exact percentiles without gathering a group into one task.

``percentile`` (SQL ``PERCENTILE``) keeps every value of a group in one
aggregation buffer, so one hot workspace lands in one task.  Here a group is
never materialised:

1. every value gets a bucket ``floor(asinh(v) * R)`` (monotone in ``v``, O(1)
   per row) and a grouped count per (group, bucket) is taken -- map-side
   partial aggregation, so hot groups cost nothing extra;
2. cumulative counts over the (small) histogram locate, for each wanted rank,
   the bucket that holds it;
3. only values inside those few buckets are read again, collapsed to
   (value, multiplicity) and ranked inside their bucket.

Buckets are ~1e-4 wide in asinh space, so a bucket of money values holds a
bounded number of distinct values; the result equals SQL ``PERCENTILE`` (linear
interpolation between the values at ``floor`` and ``ceil`` of ``p * (n - 1)``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


BUCKETS_PER_UNIT = 10_000


def exact_percentiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """One row per group of ``keys`` with a column per entry of ``probs``.

    Shuffles: the histogram and the distinct values of the target buckets
    (both pre-aggregated map-side), two windows over those small results (a
    group has at most a few hundred thousand non-empty buckets; a bucket a
    bounded number of distinct values), and the final small grouping.
    """
    v = df.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    v = v.withColumn("_b", F.floor(F.asinh("_v") * BUCKETS_PER_UNIT))

    # 1-2. histogram and cumulative counts per group.
    hist = v.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_c"))
    by_bucket = Window.partitionBy(*keys).orderBy("_b")
    hist = hist.select(
        *keys, "_b", "_c",
        F.coalesce(F.sum("_c").over(by_bucket.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.sum("_c").over(Window.partitionBy(*keys)).alias("_n"))

    # 3. the wanted ranks (floor and ceil of p * (n - 1)) that fall in each bucket.
    wanted = []
    for name, p in probs.items():
        pos = F.lit(float(p)) * (F.col("_n") - 1)
        for rank in (F.floor(pos), F.ceil(pos)):
            inside = (rank >= F.col("_before")) & (rank < F.col("_before") + F.col("_c"))
            wanted.append(F.when(inside, F.struct(F.lit(name).alias("_name"), pos.alias("_pos"),
                                                  rank.alias("_rank"))))
    located = (hist.select(*keys, "_b", "_before", F.filter(F.array(*wanted), lambda x: x.isNotNull()).alias("_w"))
               .where(F.size("_w") > 0))

    # 4. distinct values of the target buckets only, ranked inside their bucket.
    targets = located.select(*keys, "_b", "_before")
    # Aggregate before shuffling: duplicates of a hot value collapse map-side.
    values = (v.join(targets, [*keys, "_b"])
              .groupBy(*keys, "_b", "_v").agg(F.count(F.lit(1)).alias("_m"), F.first("_before").alias("_before")))
    by_value = Window.partitionBy(*keys, "_b").orderBy("_v")
    values = values.select(
        *keys, "_b", "_v", "_m",
        (F.col("_before") + F.coalesce(F.sum("_m").over(by_value.rowsBetween(Window.unboundedPreceding, -1)),
                                       F.lit(0))).alias("_start"))

    # 5. the value holding each wanted rank.
    ranks = located.select(*keys, "_b", F.explode("_w").alias("_w")).select(*keys, "_b", "_w.*")
    picked = values.join(ranks, [*keys, "_b"]).where(
        (F.col("_rank") >= F.col("_start")) & (F.col("_rank") < F.col("_start") + F.col("_m")))

    # 6. interpolate: (ceil - pos) * v[floor] + (pos - floor) * v[ceil].
    aggs, outs = [], []
    for i, name in enumerate(probs):
        mine = F.col("_name") == name
        lo, hi = F.floor("_pos"), F.ceil("_pos")
        aggs += [F.max(F.when(mine, F.col("_pos"))).alias(f"_p{i}"),
                 F.min(F.when(mine & (F.col("_rank") == lo), F.col("_v"))).alias(f"_lo{i}"),
                 F.min(F.when(mine & (F.col("_rank") == hi), F.col("_v"))).alias(f"_hi{i}")]
        pos, lo_v, hi_v = F.col(f"_p{i}"), F.col(f"_lo{i}"), F.col(f"_hi{i}")
        outs.append(F.when(F.floor(pos) == F.ceil(pos), lo_v)
                    .otherwise((F.ceil(pos) - pos) * lo_v + (pos - F.floor(pos)) * hi_v).alias(name))
    return picked.groupBy(*keys).agg(*aggs).select(*keys, *outs)


def percentiles_of_few(df: DataFrame, keys: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """As ``exact_percentiles``, for a column of few distinct values: they are
    counted map-side, and a group is its short list of values with counts."""
    counted = (df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("_v"))
               .agg(F.count(F.lit(1)).alias("_m")))
    up_to = Window.partitionBy(*keys).orderBy("_v")
    counted = counted.withColumn("_end", F.sum("_m").over(up_to)).withColumn("_n", F.sum("_m").over(Window.partitionBy(*keys)))
    outs = []
    for name, p in probs.items():
        pos = F.lit(float(p)) * (F.max("_n") - 1)
        # The value of a rank is the first whose counts so far exceed it.
        at = lambda rank: F.min(F.when(F.col("_end") > rank, F.col("_v")))
        inner = F.lit(float(p)) * (F.col("_n") - 1)
        lo, hi = at(F.floor(inner)), at(F.ceil(inner))
        outs.append(F.when(F.floor(pos) == F.ceil(pos), lo).otherwise((F.ceil(pos) - pos) * lo + (pos - F.floor(pos)) * hi).alias(name))
    return counted.groupBy(*keys).agg(*outs)
