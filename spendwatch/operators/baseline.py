"""Daily spend per cluster and the workspace baselines built from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendwatch.functions.columns import instant
from spendwatch.operators.joins import broadcast_if_fits
from spendwatch.operators.stats import exact_percentiles
from spendwatch.params import BROADCAST_MAX_ROWS, Params
from spendwatch.session import written

CLUSTER_DAY_KEYS = ["workspace_id", "usage_date", "cluster_id"]
PERCENTILES = {"p50_daily_dollars": 0.5, "p90_daily_dollars": 0.9,
               "p95_daily_dollars": 0.95, "p99_daily_dollars": 0.99}


def weekdays_only(df: DataFrame, col: str = "usage_date") -> DataFrame:
    """FL6: Monday..Friday (Spark ``weekday``: Monday = 0)."""
    return df.where(F.weekday(F.col(col)) < 5)


def cluster_day(priced: DataFrame, keep_exact: bool = False) -> DataFrame:
    """AG3: daily dollars per (workspace, day, cluster), summed exactly as
    DECIMAL and handed on as DOUBLE (``keep_exact`` also keeps the DECIMAL
    total as ``daily_exact`` for exact means downstream)."""
    out = priced.groupBy(*CLUSTER_DAY_KEYS).agg(F.sum("dollars").alias("daily_exact"))
    out = out.withColumn("daily_dollars", F.col("daily_exact").cast("double"))
    return out if keep_exact else out.drop("daily_exact")


def exact_mean(exact: str) -> Column:
    """Mean of a DECIMAL column as the DOUBLE nearest the exact sum, divided
    once by the count: independent of summation order, so every engine and
    every partitioning yields the same bits."""
    return F.sum(exact).cast("double") / F.count(F.col(exact))


def workspace_baseline(priced: DataFrame, p: Params, checkpoint: bool = True) -> DataFrame:
    """AG4-AG6 + FL7: per workspace, population statistics of positive
    weekday cluster-day spend, raw and in log space."""
    days = cluster_day(weekdays_only(priced), keep_exact=True).where(F.col("daily_dollars") > 0)
    days = days.withColumn("log_dollars", F.ln("daily_dollars"))
    if checkpoint:
        # Cluster-days are orders of magnitude smaller than usage and feed three
        # consumers (moments, histogram, ranked values): write them once to the
        # shared checkpoint directory and cut the lineage there.
        days = written(days)
    moments = days.groupBy("workspace_id").agg(
        F.count(F.lit(1)).alias("n_cluster_days"),
        exact_mean("daily_exact").alias("mean_daily_dollars"),
        F.stddev_pop("daily_dollars").alias("stddev_daily_dollars"),
        F.max("daily_dollars").alias("max_daily_dollars"),
        F.avg("log_dollars").alias("mean_log_daily_dollars"),
        F.stddev_pop("log_dollars").alias("stddev_log_daily_dollars"),
    )
    pct = exact_percentiles(days, ["workspace_id"], "daily_dollars", PERCENTILES)
    out = moments.join(pct, "workspace_id", "left")
    return out.select(
        "workspace_id",
        instant(p.as_of).alias("computed_at"),
        F.lit(p.baseline_lookback_days).cast("int").alias("lookback_days"),
        "n_cluster_days", "mean_daily_dollars", "stddev_daily_dollars",
        *PERCENTILES.keys(), "max_daily_dollars",
        "mean_log_daily_dollars", "stddev_log_daily_dollars",
    )


def baseline_latest(baselines: DataFrame) -> DataFrame:
    """SO2 (D15): the newest baseline row per workspace."""
    newest = baselines.groupBy("workspace_id").agg(
        F.max_by(F.struct(*[c for c in baselines.columns if c != "workspace_id"]), "computed_at").alias("_b"))
    return newest.select("workspace_id", "_b.*")


def _moments(value: Column, prefix: str) -> list[Column]:
    return [F.avg(value).alias(f"{prefix}mean"), (F.var_pop(value) * F.count(value)).alias(f"{prefix}m2")]


def day_moments(day_totals: DataFrame, p: Params, weekdays: bool | None = None) -> DataFrame:
    """workspace_id, usage_date, n, raw_sum, raw_mean, raw_m2, log_mean, log_m2: each day's positive
    cluster-day totals as moments; a day without any has n = 0, since it still is an as-of day."""
    weekdays = (not p.weekend_baseline) if weekdays is None else weekdays
    totals = weekdays_only(day_totals) if weekdays else day_totals
    positive = F.col("daily_dollars") > 0
    exact = F.col("daily_exact") if "daily_exact" in totals.columns else F.col("daily_dollars").cast("decimal(38,12)")
    return totals.groupBy("workspace_id", "usage_date").agg(
        F.count(F.when(positive, 1)).alias("n"),
        F.sum(F.when(positive, exact)).alias("raw_sum"),
        *_moments(F.when(positive, F.col("daily_dollars")), "raw_"),
        *_moments(F.when(positive, F.ln("daily_dollars")), "log_"),
    )


def rolling_baseline(day_totals: DataFrame, p: Params, weekdays: bool | None = None) -> DataFrame:
    """SM5 / AG9 via R3: for every as-of day D, raw and log statistics of the
    positive cluster-day totals of days ``[D - N, D - 1]``.

    Instead of pairing every cluster-day with up to N as-of days, each day is
    reduced to its moments ``(n, mean, M2)`` first; ``window_baselines`` merges them.
    """
    return window_baselines(day_moments(day_totals, p, weekdays), p)


def window_baselines(moments: DataFrame, p: Params) -> DataFrame:
    """The baseline of every day of ``moments`` from the N days before it.

    Every day's moments are copied to the N as-of days it serves (an equi-join on
    (workspace, day), no range join), and merged with the parallel-variance rule
    ``M2 = sum M2_i + sum n_i (mean_i - mean)^2``.  Exact for population
    variance; the work is days x N per workspace, independent of clusters.
    """
    as_of_days = moments.select("workspace_id", F.col("usage_date").alias("as_of_date"))
    n_days = p.baseline_lookback_days
    served = moments.where(F.col("n") > 0).withColumn(
        "as_of_date",
        F.explode(F.sequence(F.date_add("usage_date", 1), F.date_add("usage_date", n_days))))
    pairs = served.join(as_of_days, ["workspace_id", "as_of_date"])
    w = Window.partitionBy("workspace_id", "as_of_date")
    total_n = F.sum("n").over(w)
    pairs = (pairs
             .withColumn("_n", total_n)
             .withColumn("_raw_mu", F.sum("raw_sum").over(w).cast("double") / F.col("_n"))
             .withColumn("_log_mu", F.sum(F.col("n") * F.col("log_mean")).over(w) / F.col("_n")))
    merged = pairs.groupBy("workspace_id", "as_of_date").agg(
        F.first("_n").alias("baseline_n"),
        F.first("_raw_mu").alias("baseline_mean"),
        F.first("_log_mu").alias("baseline_mean_log"),
        F.sum(F.col("raw_m2") + F.col("n") * (F.col("raw_mean") - F.col("_raw_mu")) ** 2).alias("_raw_m2"),
        F.sum(F.col("log_m2") + F.col("n") * (F.col("log_mean") - F.col("_log_mu")) ** 2).alias("_log_m2"),
    )
    return merged.select(
        "workspace_id", "as_of_date", "baseline_mean",
        F.sqrt(F.col("_raw_m2") / F.col("baseline_n")).alias("baseline_stddev"),
        "baseline_mean_log",
        F.sqrt(F.col("_log_m2") / F.col("baseline_n")).alias("baseline_stddev_log"),
        "baseline_n",
    )


def attach_baseline(df: DataFrame, baseline: DataFrame, on: list[str]) -> DataFrame:
    """Left join of a per-workspace (or per workspace-day) baseline, broadcast
    behind a size check; beyond it the planner chooses."""
    return df.join(broadcast_if_fits(baseline, BROADCAST_MAX_ROWS), on, "left")
