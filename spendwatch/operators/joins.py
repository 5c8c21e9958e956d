"""Join helpers: size-checked broadcast and the temporal (interval) join."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendwatch.functions.columns import OPEN_END
from spendwatch.session import written

# The largest side that is broadcast, the size a row is taken for where only a
# number of rows is given, and how much smaller a compressed file may be than its rows.
BROADCAST_MAX_BYTES = 64 << 20
ROW_BYTES = 128
PACKING = 4


def planned_bytes(df: DataFrame) -> int:
    """The optimizer's size of ``df``: exact for local rows, from the files for a scan."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def bounded(df: DataFrame, max_rows: int) -> tuple[DataFrame, bool]:
    """``df`` and whether it may be broadcast: at most BROADCAST_MAX_BYTES, and
    no more than ``max_rows`` rows of ROW_BYTES.

    The optimizer's size answers without a job when it is small.  Where it is not
    (joins are estimated as products), the frame is computed once into the scratch
    folder and its written size decides, so no side runs twice.  The written table
    comes back in place of ``df``.
    """
    limit = min(BROADCAST_MAX_BYTES, max_rows * ROW_BYTES)
    if limit <= 0:
        return df, False
    if planned_bytes(df) <= limit:
        return df, True
    df = written(df, "side")
    return df, planned_bytes(df) <= limit // PACKING


def broadcast_if_fits(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``df`` only behind a check of its size; otherwise leave the
    choice to the planner (sort-merge / shuffle-hash, AQE skew splits)."""
    df, fits = bounded(df, max_rows)
    return F.broadcast(df) if fits else df


def join_small_side(a: DataFrame, b: DataFrame, on: str | list[str], max_rows: int) -> DataFrame:
    """``a`` joined with ``b``, broadcasting whichever the optimizer knows to be
    small; if it knows neither, ``b`` behind its written size."""
    limit = min(BROADCAST_MAX_BYTES, max_rows * ROW_BYTES)
    if planned_bytes(b) > limit >= planned_bytes(a):
        return F.broadcast(a).join(b, on)
    return a.join(broadcast_if_fits(b, max_rows), on)


def broadcast_if_known_small(df: DataFrame, known_rows: int, max_rows: int) -> DataFrame:
    """Broadcast a side whose row count is known without running a job (for
    example a frame built from a configuration list)."""
    return F.broadcast(df) if known_rows <= max_rows else df


def _clamp(d: Column, lo: dt.date, hi: dt.date) -> Column:
    return F.least(F.greatest(d, F.lit(lo)), F.lit(hi))


def price_join(usage: DataFrame, prices: DataFrame, how: str, lo: dt.date, hi: dt.date,
               max_rows: int) -> DataFrame:
    """JN1/JN2: attach the price in force at ``usage_start_time``.

    The price is valid on ``[price_start_time, price_end_time)``; a NULL end is
    open.  ``how`` is ``inner`` (drop unpriced rows) or ``left`` (keep them with
    a NULL price).  Overlapping intervals fan a row out, as in SQL.

    Plan: when the price table passes the size check it is broadcast and the
    join is a BroadcastHashJoin on ``sku_name`` with the interval as residual
    condition.  Beyond that size the intervals are cut into day buckets
    clamped to ``[lo, hi]`` (the usage window) and joined on
    ``(sku_name, bucket)``: a shuffle join whose keys spread over days, with
    the same result (clamping is monotone, so the bucket of every usage row
    lies inside the bucket range of every interval that contains it).
    """
    p = prices.select(
        F.col("sku_name").alias("_p_sku"),
        F.col("price_start_time").alias("_p_start"),
        F.coalesce(F.col("price_end_time"), F.to_timestamp(F.lit(OPEN_END))).alias("_p_end"),
        F.col("pricing.default").alias("dollars_per_dbu"),
    )
    within = (F.col("usage_start_time") >= F.col("_p_start")) & (F.col("usage_start_time") < F.col("_p_end"))
    p, fits = bounded(p, max_rows)
    if fits:
        joined = usage.join(F.broadcast(p), (F.col("sku_name") == F.col("_p_sku")) & within, how)
        return joined.drop("_p_sku", "_p_start", "_p_end")
    buckets = p.withColumn(
        "_p_day",
        F.explode(F.sequence(_clamp(F.to_date("_p_start"), lo, hi), _clamp(F.to_date("_p_end"), lo, hi))))
    u = usage.withColumn("_u_day", _clamp(F.to_date("usage_start_time"), lo, hi))
    cond = (F.col("sku_name") == F.col("_p_sku")) & (F.col("_u_day") == F.col("_p_day")) & within
    return u.join(buckets, cond, how).drop("_p_sku", "_p_start", "_p_end", "_p_day", "_u_day")
