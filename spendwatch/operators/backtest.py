"""Hour-by-hour replay of history: how early would each bad day have fired?"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendwatch.functions.columns import log_z
from spendwatch.operators.alerts import latest_by
from spendwatch.operators.baseline import CLUSTER_DAY_KEYS, attach_baseline, rolling_baseline
from spendwatch.operators.stats import percentiles_of_few
from spendwatch.operators.usage import hourly_spend
from spendwatch.params import Params
from spendwatch.session import written

def _day() -> Window:
    return Window.partitionBy(*CLUSTER_DAY_KEYS)


def cumulative(hourly: DataFrame) -> DataFrame:
    """WN3-WN5 (+R4): running dollars and DBUs, hours observed, and the day
    total, all from one partitioning on (workspace, day, cluster).  A group is
    at most 24 hourly rows, so no key can be hot here."""
    ordered = _day().orderBy("hour_of_day", "hour_ts")
    running = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return hourly.select(
        *CLUSTER_DAY_KEYS, "hour_of_day", "hour_ts",
        F.sum("dollars").over(running).cast("double").alias("cumulative_dollars"),
        F.sum("dbus").over(running).cast("double").alias("cumulative_dbus"),
        F.row_number().over(ordered).alias("hours_observed"),
        F.sum("dollars").over(_day()).alias("day_exact"),
    ).withColumn("day_dollars", F.col("day_exact").cast("double"))


def cluster_day_totals(cum: DataFrame) -> DataFrame:
    """Daily totals read off the cumulative frame; same partitioning, so no
    extra shuffle."""
    return cum.groupBy(*CLUSTER_DAY_KEYS).agg(
        F.max("day_dollars").alias("daily_dollars"), F.max("day_exact").alias("daily_exact"))


def project_running(cum: DataFrame) -> DataFrame:
    """PR29: average $/hour so far x 24."""
    return cum.withColumn(
        "projected_daily_dollars", F.col("cumulative_dollars") / F.col("hours_observed") * 24.0)


def simulate(cum: DataFrame, rolling: DataFrame, p: Params) -> DataFrame:
    """JN6 + PR18: each hour scored against the baseline as of its day
    (prior days only).  The rolling baseline is one row per (workspace, day)
    of the replay window -- a bounded broadcast."""
    rb = rolling.withColumnRenamed("as_of_date", "usage_date")
    df = attach_baseline(project_running(cum), rb, ["workspace_id", "usage_date"])
    z = log_z(F.col("projected_daily_dollars"), F.col("baseline_mean_log"), F.col("baseline_stddev_log"))
    return df.withColumn("z_score", z)


def replay_tier(p: Params) -> Column:
    """PR20: budget first, then z; a NULL z falls through to OK."""
    projected, z = F.col("projected_daily_dollars"), F.col("z_score")
    tier = F.when(z > p.z_critical, "CRITICAL").when(z > p.z_warning, "WARNING").otherwise("OK")
    if p.use_budget_rule:
        tier = F.when(projected > p.budget_daily_dollars, "CRITICAL").otherwise(tier)
    return tier


def first_fire_aggs(p: Params) -> list[Column]:
    """AG11: first alert / critical / budget-crossing hour, last active hour
    and the largest z of the day."""
    sig, hour = F.col("sim_signal"), F.col("hour_of_day")
    return [
        F.max("z_score").alias("z_score"),
        F.min(F.when(sig.isin("CRITICAL", "WARNING"), hour)).alias("first_alert_hour"),
        F.min(F.when(sig == "CRITICAL", hour)).alias("first_critical_hour"),
        F.min(F.when(F.col("cumulative_dollars") > p.budget_daily_dollars, hour)).alias("budget_crossed_hour"),
        F.max(hour).alias("last_active_hour"),
    ]


def first_fire(tiered: DataFrame, p: Params) -> DataFrame:
    return tiered.groupBy(*CLUSTER_DAY_KEYS).agg(*first_fire_aggs(p))


def bad_days(hourly: DataFrame, p: Params) -> DataFrame:
    """AG10 + FL12: cluster-days that cost strictly more than the budget."""
    return (hourly.groupBy(*CLUSTER_DAY_KEYS).agg(F.sum("dollars").cast("double").alias("actual_daily_dollars"))
            .where(F.col("actual_daily_dollars") > p.budget_daily_dollars))


def outcome() -> Column:
    """PR30."""
    fa, bc = F.col("first_alert_hour"), F.col("budget_crossed_hour")
    return (F.when(fa.isNull(), "MISS").when(bc.isNull(), "CAUGHT_EARLY")
            .when(fa < bc, "CAUGHT_EARLY").when(fa == bc, "CAUGHT_AT_CROSSING").otherwise("CAUGHT_LATE"))


def lead_hours() -> Column:
    """PR31: NULL unless both hours exist."""
    fa, bc = F.col("first_alert_hour"), F.col("budget_crossed_hour")
    return F.when(fa.isNotNull() & bc.isNotNull(), bc - fa)


def replay(hourly: DataFrame, p: Params) -> DataFrame:
    """Tiered hours of the replay: cumulative frame, rolling baseline, z, tier."""
    cum = cumulative(hourly)
    rolling = rolling_baseline(cluster_day_totals(cum), p)
    return simulate(cum, rolling, p).withColumn("sim_signal", replay_tier(p))


def backtest(usage: DataFrame, prices: DataFrame, excluded: DataFrame, p: Params) -> DataFrame:
    """Bad cluster-days with their first-fire hours and outcome (R4: one
    grouped pass over the tiered hours -- the day total rides along from the
    window, so bad days need no second aggregation and no re-join).

    The hourly aggregate feeds the replay and the rolling baseline: it is
    written once to the shared folder, so usage is scanned once."""
    hourly = written(hourly_spend(usage, prices, excluded, p))
    tiered = replay(hourly, p)
    if p.warmup_days:
        start = p.as_of_date - dt.timedelta(days=p.backtest_lookback_days)
        tiered = tiered.where(F.col("usage_date") >= F.lit(start))
    days = tiered.groupBy(*CLUSTER_DAY_KEYS).agg(
        F.max("day_dollars").alias("actual_daily_dollars"), *first_fire_aggs(p))
    return days.where(F.col("actual_daily_dollars") > p.budget_daily_dollars).select(
        *CLUSTER_DAY_KEYS, "actual_daily_dollars", "z_score", "first_alert_hour", "first_critical_hour",
        "budget_crossed_hour", "last_active_hour", outcome().alias("outcome"), lead_hours().alias("lead_hours"))


def latest_meta(history: DataFrame) -> DataFrame:
    """WN2 + PR33: the newest recorded name and owner per cluster."""
    order = [F.col("change_time").desc_nulls_last(), F.col("change_seq").desc_nulls_last()]
    return latest_by(history, ["workspace_id", "cluster_id"], order).select(
        "workspace_id", "cluster_id", "cluster_name", F.col("owned_by").alias("creator"))


def meta_for(results: DataFrame, history: DataFrame) -> DataFrame:
    """Latest metadata of the clusters that occur in ``results`` only: the
    (large) version history is semi-joined with the result keys before the
    versions are ranked."""
    keys = results.select("workspace_id", "cluster_id").distinct()
    return latest_meta(history.join(keys, ["workspace_id", "cluster_id"], "left_semi"))


def enrich(results: DataFrame, meta: DataFrame) -> DataFrame:
    """JN8: metadata joined last, after the heavy aggregation."""
    out = results.join(meta, ["workspace_id", "cluster_id"], "left")
    return out.select(
        "workspace_id", "usage_date", "cluster_id", "cluster_name", "creator", "actual_daily_dollars",
        "z_score", "first_alert_hour", "first_critical_hour", "budget_crossed_hour", "last_active_hour",
        "outcome", "lead_hours")


def backtest_summary(results: DataFrame, checkpoint: bool = True) -> DataFrame:
    """AG18: per workspace and outcome -- days, share of the workspace's bad
    days, lead-time median / p90 (exact) and dollars.  ``results`` feeds three
    consumers, so it is written once unless it is already a table."""
    if checkpoint:
        results = written(results)
    exact = F.col("actual_daily_dollars").cast("decimal(38,12)")
    grouped = results.groupBy("workspace_id", "outcome").agg(
        F.count(F.lit(1)).alias("n_days"), F.sum(exact).cast("double").alias("dollars"))
    share = F.col("n_days") / F.sum("n_days").over(Window.partitionBy("workspace_id"))
    # A lead is one of 24 numbers.
    leads = percentiles_of_few(results, ["workspace_id", "outcome"], "lead_hours", {"lead_p50": 0.5, "lead_p90": 0.9})
    return grouped.withColumn("share", share).join(leads, ["workspace_id", "outcome"], "left").select(
        "workspace_id", "outcome", "n_days", "share", "lead_p50", "lead_p90", "dollars")
