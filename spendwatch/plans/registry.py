"""``queries()``: one callable ``(spark, sf_dir) -> DataFrame`` per operator of
the inventory.  Column names equal the DuckDB oracle's (``oracle.py``);
doubles are rounded to 6 places on both sides."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendwatch import schemas as S
from spendwatch.functions.columns import driver_type, is_photon, photon_flag, worker_count
from spendwatch.operators import alerts, backtest, baseline, daily, globs, latest, pricing, published, replay, scoring, sinks, usage
from spendwatch.plans import streams
from spendwatch.plans.inputs import Inputs, older
from spendwatch.session import scratch_path, written
from spendwatch.sources import fixtures as fx
from spendwatch.sources.readers import rate_card_scan, write_json_arrays, write_json_lines

U, B, SC, AL = fx.USAGE_PARAMS, fx.BACKTEST_PARAMS, fx.SCORING_PARAMS, fx.ALERT_PARAMS


def r6(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[F.round(F.col(c), 6).alias(c) if c in cols else F.col(c) for c in df.columns])


def dbl(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) if c in cols else F.col(c) for c in df.columns])


def count_by(df: DataFrame, *keys) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


# --- scans / filters -------------------------------------------------------------
def q_usage_scan(i: Inputs) -> DataFrame:
    return dbl(usage.usage_scan(i.usage, U), "usage_quantity")


def q_usage_window(i: Inputs) -> DataFrame:
    return count_by(usage.in_window(i.usage, "usage_date", U, U.baseline_lookback_days), "usage_date")


def q_usage_photon_flag(i: Inputs) -> DataFrame:
    return count_by(i.usage.select("sku_name", photon_flag(F.col("sku_name")).alias("photon")), "sku_name", "photon")


def q_active_clusters(i: Inputs) -> DataFrame:
    return usage.active_clusters(i.usage, U)


def q_excluded_resolved(i: Inputs) -> DataFrame:
    return i.excluded(U, U.baseline_lookback_days)


def q_usage_not_excluded(i: Inputs) -> DataFrame:
    rows = usage.drop_excluded(usage.usage_scan(i.usage, U), i.excluded(U, U.baseline_lookback_days))
    return count_by(rows, "workspace_id", "cluster_id")


def q_priced_usage(i: Inputs) -> DataFrame:
    return dbl(i.priced(U), "dbus", "dollars_per_dbu", "dollars")


def q_price_overlaps(i: Inputs) -> DataFrame:
    return usage.price_overlaps(i.usage, i.prices, U)


def q_customer_rates(i: Inputs) -> DataFrame:
    return i.customer_rates(U)


def q_cluster_day(i: Inputs) -> DataFrame:
    return baseline.cluster_day(i.priced(U))


def q_cluster_day_weekday(i: Inputs) -> DataFrame:
    return baseline.weekdays_only(baseline.cluster_day(i.priced(U)))


BASELINE_STATS = ["stddev_daily_dollars", "p50_daily_dollars", "p90_daily_dollars",
                  "p95_daily_dollars", "p99_daily_dollars", "max_daily_dollars", "mean_log_daily_dollars",
                  "stddev_log_daily_dollars"]


def q_workspace_baseline(i: Inputs) -> DataFrame:
    return r6(i.baseline(U).drop("computed_at"), *BASELINE_STATS)


def q_baseline_latest(i: Inputs) -> DataFrame:
    both = i.baseline(older(U, 7)).unionByName(i.baseline(U))
    return baseline.baseline_latest(both).select("workspace_id", "mean_daily_dollars")


# --- pricing ---------------------------------------------------------------------------
def q_rate_card_scan(i: Inputs) -> DataFrame:
    path = write_json_lines(i.card, scratch_path(i.spark, "rate-card"))
    return rate_card_scan(i.spark, path, multi_line=False)


def q_rate_card_array(i: Inputs) -> DataFrame:
    return rate_card_scan(i.spark, write_json_arrays(i.card, scratch_path(i.spark, "rate-card-arrays")))


def q_rate_card_all_purpose(i: Inputs) -> DataFrame:
    return pricing.all_purpose(i.card)


def q_rate_card_normalised(i: Inputs) -> DataFrame:
    return count_by(pricing.all_purpose(pricing.normalise_gcp(i.card)), "node_type")


def q_fleet_aliases(i: Inputs) -> DataFrame:
    return pricing.expand_aliases(pricing.all_purpose(i.card), i.aliases).select(
        "node_type", "photon", "dbu_per_hour")


def q_pricing_rates(i: Inputs) -> DataFrame:
    return r6(i.rates(SC).drop("refreshed_at"), "dollars_per_hour")


def q_rate_lookup_fallback(i: Inputs) -> DataFrame:
    return r6(pricing.rates_with_fallback(i.rates(SC)), "dollars_per_hour")


# --- inventory / scoring ------------------------------------------------------------------
def q_live_inventory(i: Inputs) -> DataFrame:
    return scoring.live_inventory(i.inventory).select(
        "workspace_id", "cluster_id", "snapshot_ts", "state", "cluster_source")


def q_worker_count(i: Inputs) -> DataFrame:
    return count_by(i.inventory_workers.select("workspace_id", "cluster_id", worker_count().alias("num_workers")),
                    "workspace_id", "cluster_id", "num_workers")


def q_inventory_photon(i: Inputs) -> DataFrame:
    return count_by(i.inventory.select("workspace_id", "cluster_id", is_photon().alias("photon")),
                    "workspace_id", "cluster_id", "photon")


def q_inventory_driver_type(i: Inputs) -> DataFrame:
    return count_by(i.inventory.select("cluster_id", F.col("node_type_id").alias("node_type"),
                                       driver_type().alias("driver_node_type")),
                    "cluster_id", "node_type", "driver_node_type")


def q_rate_lookup(i: Inputs) -> DataFrame:
    df = scoring.lookup_exact(scoring.live_inventory(i.inventory), i.rates(SC), SC)
    return df.select("cluster_id", "snapshot_ts", F.col("drv_dbu").alias("driver_dbu"),
                     F.col("wkr_dbu").alias("worker_dbu"))


def _scored(i: Inputs) -> DataFrame:
    return i.scores(SC)


def q_projected_spend(i: Inputs) -> DataFrame:
    df = _scored(i).where(F.col("dbu_per_hour").isNotNull())
    return r6(df.select("cluster_id", "snapshot_ts", "dbu_per_hour", "dollars_per_hour", "projected_daily_dollars"),
              "dbu_per_hour", "dollars_per_hour", "projected_daily_dollars")


def q_z_scores(i: Inputs) -> DataFrame:
    return r6(_scored(i).select("cluster_id", "snapshot_ts", "z_score"), "z_score")


def q_exclusion_reasons(i: Inputs) -> DataFrame:
    df = scoring.exclusion_reason(i.inventory, i.rules, SC).where(F.col("excluded_reason").isNotNull())
    return df.select("cluster_id", "cluster_name", F.col("creator_user_name").alias("creator"),
                     F.col("excluded_reason").alias("reason")).distinct()


def q_glob_exclusions(i: Inputs) -> DataFrame:
    """Every recorded cluster name against a rule table of its own size."""
    return globs.first_matching(i.history, "cluster_name", fx.glob_rules(i.spark, i.sf_dir)).withColumnRenamed("name", "cluster_name")


def q_score_reasons(i: Inputs) -> DataFrame:
    return count_by(_scored(i), "signal", "reason")


SCORE_DOUBLES = ["dbu_per_hour", "dollars_per_hour", "projected_daily_dollars", "baseline_stddev", "z_score"]


def q_cluster_scores(i: Inputs) -> DataFrame:
    return r6(_scored(i), *SCORE_DOUBLES)


def q_scores_of_one_cloud(i: Inputs) -> DataFrame:
    """FL9: rates of a second cloud, at ten times the price, change nothing."""
    rates = i.rates_table(SC)
    dearer = [(F.col(c) * 10).alias(c) if c in ("dbu_per_hour", "dollars_per_dbu", "dollars_per_hour") else F.lit("GCP").alias(c) if c == "cloud"
              else F.col(c) for c in rates.columns]
    both = rates.unionByName(rates.select(*dearer))
    return count_by(scoring.score_inventory(i.inventory, both, i.baseline_table(SC), i.rules, SC), "signal", "reason")


def q_signal_summary(i: Inputs) -> DataFrame:
    return scoring.signal_summary(_scored(i))


# --- alerts -----------------------------------------------------------------------------------
def q_latest_snapshot(i: Inputs) -> DataFrame:
    return alerts.latest_by(_scored(i), alerts.KEYS, alerts.score_order()).select(
        "workspace_id", "cluster_id", "snapshot_ts", "signal")


def q_latest_state_table(i: Inputs) -> DataFrame:
    """Scores added year by year to a table of the newest row per cluster; one year comes late and twice."""
    path, year = scratch_path(i.spark, "latest-state"), F.date_format("snapshot_date", "yyyy")
    staged = i.table("scores-once", _scored(i))
    polls = [str(y) for y in range(1995, 2002)]
    for poll in [polls[0], *polls[2:5], polls[1], *polls[5:], polls[1]]:
        latest.add_poll(staged.where(year == poll), path, poll, fan=2)
    return latest.latest_state(i.spark, path).select("workspace_id", "cluster_id", "snapshot_ts", "signal")


def q_alerts_latest(i: Inputs) -> DataFrame:
    return r6(i.alerts(AL), "dbu_per_hour", "dollars_per_hour", "projected_daily_dollars", "z_score")


def q_monitor_heartbeat(i: Inputs) -> DataFrame:
    return alerts.heartbeat(_scored(i), AL)


def q_last_send(i: Inputs) -> DataFrame:
    return alerts.last_send(i.send_log(AL))


def q_alerts_to_send(i: Inputs) -> DataFrame:
    return r6(i.to_send(AL).select("workspace_id", "cluster_id", "signal", "projected_daily_dollars"),
              "projected_daily_dollars")


def q_alert_routing(i: Inputs) -> DataFrame:
    return alerts.route(i.alerts(AL), i.directory, AL).select(
        "cluster_id", "signal", "creator", "recipient", "routing")


def q_alert_messages(i: Inputs) -> DataFrame:
    routed = alerts.route(i.alerts(AL), i.directory, AL)
    return alerts.render(routed, i.baseline(U), AL).select(
        "cluster_id", "signal", "headline", "body", "plain", "link")


def q_alert_outbox(i: Inputs) -> DataFrame:
    return alerts.alert_outbox(i.to_send(AL), i.baseline(U), i.directory, AL)


def q_suppression_replay(i: Inputs) -> DataFrame:
    return replay.sends_over_history(_scored(i), AL)


def q_send_audit(i: Inputs) -> DataFrame:
    return alerts.send_audit(i.send_log(AL))


def q_exclusion_audit(i: Inputs) -> DataFrame:
    return alerts.exclusion_audit(_scored(i))


# --- backtest --------------------------------------------------------------------------------
def q_hourly_spend(i: Inputs) -> DataFrame:
    return dbl(i.hourly(B), "dbus", "dollars")


def q_hourly_cumulative(i: Inputs) -> DataFrame:
    return backtest.cumulative(i.hourly(B)).select(
        "workspace_id", "usage_date", "cluster_id", "hour_of_day", "cumulative_dollars", "cumulative_dbus",
        "hours_observed")


def q_hourly_projection(i: Inputs) -> DataFrame:
    df = backtest.project_running(backtest.cumulative(i.hourly(B)))
    return r6(df.select("workspace_id", "usage_date", "cluster_id", "hour_of_day", "projected_daily_dollars"),
              "projected_daily_dollars")


def q_rolling_baseline(i: Inputs) -> DataFrame:
    totals = backtest.cluster_day_totals(backtest.cumulative(i.hourly(B)))
    return r6(baseline.rolling_baseline(totals, B), "baseline_stddev", "baseline_mean_log", "baseline_stddev_log")


def q_rolling_baseline_daily(i: Inputs) -> DataFrame:
    """The baselines of each month from stored days, as of when the month was added; one month is
    repeated after a partial first attempt."""
    totals = i.table("day-totals", backtest.cluster_day_totals(backtest.cumulative(i.hourly(B))))
    path = scratch_path(i.spark, "day-moments")
    start, last = B.as_of.date() - dt.timedelta(days=B.backtest_lookback_days), B.as_of.date()
    out = None
    while start <= last:
        following = (start.replace(day=1) + dt.timedelta(days=32)).replace(day=1)
        month = totals.where((F.col("usage_date") >= F.lit(start)) & (F.col("usage_date") < F.lit(following)))
        if out is not None:
            daily.add_days(month.where(F.dayofmonth("usage_date") < 9), path, f"{start:%Y-%m}", B)
        daily.add_days(month, path, f"{start:%Y-%m}", B)
        now = written(daily.baselines_between(i.spark, path, start, following - dt.timedelta(days=1), B), "baselines")
        out = now if out is None else out.unionByName(now)
        start = following
    return r6(out, "baseline_stddev", "baseline_mean_log", "baseline_stddev_log")


def q_bad_cluster_days(i: Inputs) -> DataFrame:
    return backtest.bad_days(i.hourly(B), B)


def _tiered(i: Inputs) -> DataFrame:
    return backtest.replay(i.hourly(B), B)


def q_backtest_simulated(i: Inputs) -> DataFrame:
    return r6(_tiered(i).select("workspace_id", "usage_date", "cluster_id", "hour_of_day",
                                "projected_daily_dollars", "z_score"), "projected_daily_dollars", "z_score")


def q_backtest_tiers(i: Inputs) -> DataFrame:
    return _tiered(i).select("workspace_id", "usage_date", "cluster_id", "hour_of_day", "sim_signal")


def q_first_fire(i: Inputs) -> DataFrame:
    return r6(backtest.first_fire(_tiered(i), B), "z_score")


def q_backtest_results(i: Inputs) -> DataFrame:
    return r6(i.backtest(B), "z_score")


def q_backtest_z_only(i: Inputs) -> DataFrame:
    return r6(i.backtest(fx.Z_ONLY_PARAMS), "z_score")


def q_cluster_meta_latest(i: Inputs) -> DataFrame:
    return backtest.latest_meta(i.history)


def q_backtest_enriched(i: Inputs) -> DataFrame:
    raw = written(i.backtest(B))  # two consumers
    return r6(backtest.enrich(raw, backtest.meta_for(raw, i.history)), "z_score")


def q_backtest_summary(i: Inputs) -> DataFrame:
    return r6(backtest.backtest_summary(i.backtest(B)), "lead_p50", "lead_p90")


# --- sinks -------------------------------------------------------------------------------------
def q_sink_overwrite_roundtrip(i: Inputs) -> DataFrame:
    path = scratch_path(i.spark, "pricing-rates")
    sinks.overwrite(i.rates(SC).drop("refreshed_at"), path)
    sinks.overwrite(i.rates(SC).drop("refreshed_at"), path)  # a second run replaces, not adds
    return r6(i.spark.read.parquet(path), "dollars_per_hour")


def q_sink_append_roundtrip(i: Inputs) -> DataFrame:
    path = scratch_path(i.spark, "signals")
    summary = _scored(i).select("signal")
    sinks.append(summary, path)
    sinks.append(summary, path)
    return count_by(i.spark.read.parquet(path), "signal")


def q_sink_partitioned_scores(i: Inputs) -> DataFrame:
    path = scratch_path(i.spark, "cluster-scores")
    sinks.write_scores(_scored(i), path)
    lo = alerts.recency_cutoff(AL).date()
    back = sinks.read_scores(i.spark, path).where(
        (F.col("snapshot_date") >= F.lit(lo)) & (F.col("snapshot_date") <= F.lit(AL.as_of.date())))
    return count_by(back, "snapshot_date")


def q_sink_versions(i: Inputs) -> DataFrame:
    """A table read before, after a failed and after a successful rewrite."""
    path = scratch_path(i.spark, "baseline-versions")
    columns = ["workspace_id", "lookback_days", "n_cluster_days", "mean_daily_dollars"]
    old, new = (i.baseline(p).select(*columns) for p in (older(U, 7), U))
    published.publish(old, path)
    reads = [("bound before", published.current(i.spark, path, old.schema))]
    # Fails after rows of the new version have been written.
    broken = new.withColumn("lookback_days", F.when(F.col("n_cluster_days") > 0, F.raise_error(F.lit("lost midway")).cast("int")))
    try:
        published.publish(broken, path)
    except PySparkException as lost:
        if "lost midway" not in str(lost):
            raise
        reads.append(("after a failure", published.current(i.spark, path, old.schema)))
    published.publish(new, path)
    reads.append(("after the rewrite", published.current(i.spark, path, new.schema)))
    out = None
    for label, frame in reads:
        frame = frame.withColumn("reader", F.lit(label))
        out = frame if out is None else out.unionByName(frame)
    return out


def q_sink_repeated_runs(i: Inputs) -> DataFrame:
    """Scores added year by year, one run twice after a partial first attempt: each row once.
    Unpartitioned, since a year of the fixture holds hundreds of dates."""
    path, year = scratch_path(i.spark, "scores-by-run"), F.date_format("snapshot_date", "yyyy")
    staged = i.table("scores-once", _scored(i))
    runs = [str(y) for y in range(1995, 2002)]
    for run in [*runs[:3], runs[1], *runs[3:], runs[1]]:
        rows = staged.where(year == run)
        if run == runs[1]:
            half = rows.where(F.pmod(F.xxhash64("cluster_id", "snapshot_ts"), F.lit(2)) == 0)
            published.append_run(half, path, run, fan=2)
        published.append_run(rows, path, run, fan=2)
    return count_by(published.current_runs(i.spark, path, S.CLUSTER_SCORES), published.RUN, "signal")


# --- streaming ------------------------------------------------------------------------------------
def q_stream_scores(i: Inputs) -> DataFrame:
    out = streams.scores_from_inventory(i, SC)
    return r6(out.select(*[c.name for c in S.CLUSTER_SCORES.fields]), *SCORE_DOUBLES)


def q_stream_hourly_spend(i: Inputs) -> DataFrame:
    return dbl(streams.hourly_from_usage(i, B), "dbus", "dollars")


def q_stream_suppression(i: Inputs) -> DataFrame:
    out = streams.suppression_from_alerts(i, AL)
    return r6(out.select("workspace_id", "cluster_id", "signal", "projected_daily_dollars"),
              "projected_daily_dollars")


def q_stream_hourly_complete(i: Inputs) -> DataFrame:
    return dbl(streams.hourly_with_corrections(i, B), "dbus", "dollars")


def q_stream_resolved(i: Inputs) -> DataFrame:
    return streams.resolved_from_scores(i, fx.RESOLVE_PARAMS)


def q_stream_sends(i: Inputs) -> DataFrame:
    return streams.sends_from_history(i, AL).select("workspace_id", "cluster_id", "signal", F.col("snapshot_ts").alias("sent_at"))


_QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}


def _bind(fn: Callable[[Inputs], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Inputs(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _bind(fn) for name, fn in _QUERIES.items()}
