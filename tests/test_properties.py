"""Properties and rewrite equivalences on the fixture tables (sf0.001 / sf0.01)."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from spendwatch.operators import alerts, backtest, baseline, pricing, scoring, usage
from spendwatch.plans.inputs import Inputs
from spendwatch.sources import fixtures as fx
from tests.conftest import SF_MID, SF_SMALL


@pytest.fixture(scope="module")
def mid(spark):
    return Inputs(spark, SF_MID)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is not None, x) for x in r))


def test_excluded_clusters_never_alert(mid):
    scores = mid.scores()
    excluded = scores.where(F.col("signal") == "EXCLUDED").select("workspace_id", "cluster_id").distinct()
    al = mid.alerts()
    assert al.join(excluded, ["workspace_id", "cluster_id"]).where(
        ~F.col("reason").contains("exclu") & ~F.col("reason").contains("pattern")).count() == 0
    assert al.where(F.col("signal").isin("EXCLUDED", "UNKNOWN", "OK")).count() == 0


def test_tier_is_monotone_in_projection(mid):
    sev = F.when(F.col("signal") == "CRITICAL", 2).when(F.col("signal") == "WARNING", 1).otherwise(0)
    scored = mid.scores().where(F.col("signal").isin("OK", "WARNING", "CRITICAL")).withColumn("sev", sev)
    w = Window.partitionBy("workspace_id").orderBy("projected_daily_dollars")
    bad = scored.withColumn("prev", F.max("sev").over(w.rowsBetween(Window.unboundedPreceding, -1))).where(
        F.col("prev") > F.col("sev"))
    assert bad.count() == 0


def test_running_sum_at_last_hour_is_daily_sum(mid):
    cum = backtest.cumulative(mid.hourly(fx.BACKTEST_PARAMS))
    last = cum.groupBy(*baseline.CLUSTER_DAY_KEYS).agg(F.max_by("cumulative_dollars", "hours_observed").alias("c"),
                                                       F.max("day_dollars").alias("d"))
    assert last.where(F.abs(F.col("c") - F.col("d")) > 1e-6).count() == 0


def test_outcome_invariant_d7(mid):
    # With the budget rule and <= 24 hourly rows per day, MISS and CAUGHT_LATE cannot occur.
    out = {r.outcome for r in mid.backtest(fx.BACKTEST_PARAMS).select("outcome").distinct().collect()}
    assert out <= {"CAUGHT_EARLY", "CAUGHT_AT_CROSSING"}
    z_only = mid.backtest(fx.BACKTEST_PARAMS.replace(use_budget_rule=False))
    assert z_only.where(F.col("outcome") == "MISS").count() > 0


def test_r1_recency_below_rank_equals_rank_then_filter(mid):
    scores = mid.scores()
    p = fx.ALERT_PARAMS
    ranked = alerts.latest_by(scores, alerts.KEYS, alerts.score_order())
    brute = ranked.where(F.col("signal").isin("WARNING", "CRITICAL")
                         & (F.col("snapshot_ts") >= F.lit(p.as_of - p.alert_recency)))
    assert rows(alerts.alerts_latest(scores, p)) == rows(brute.select(*alerts.S.ALERT_COLUMNS))


def test_r2_anti_join_equals_last_send_filter(mid):
    p = fx.ALERT_PARAMS
    al, log = mid.alerts(p), mid.send_log(p)
    ls = alerts.last_send(log)
    crit = p.as_of - dt.timedelta(hours=p.critical_suppression_hours)
    warn = p.as_of - dt.timedelta(hours=p.warning_suppression_hours)
    brute = al.join(ls, ["workspace_id", "cluster_id", "signal"], "left").where(
        F.col("last_sent_at").isNull()
        | ((F.col("signal") == "CRITICAL") & (F.col("last_sent_at") < F.lit(crit)))
        | ((F.col("signal") == "WARNING") & (F.col("last_sent_at") < F.lit(warn)))).select(*al.columns)
    assert rows(alerts.alerts_to_send(al, log, p)) == rows(brute)


@pytest.mark.parametrize("weekend", [False, True])
def test_r3_rolling_moments_equal_range_join(mid, weekend):
    p = fx.BACKTEST_PARAMS.replace(weekend_baseline=weekend)
    totals = backtest.cluster_day_totals(backtest.cumulative(mid.hourly(p)))
    fast = baseline.rolling_baseline(totals, p)
    t = baseline.weekdays_only(totals) if not weekend else totals
    days = t.select("workspace_id", F.col("usage_date").alias("as_of_date")).distinct()
    pos = t.where(F.col("daily_dollars") > 0)
    brute = days.join(pos, (days.workspace_id == pos.workspace_id)
                      & (pos.usage_date >= F.date_sub(days.as_of_date, p.baseline_lookback_days))
                      & (pos.usage_date <= F.date_sub(days.as_of_date, 1))).groupBy(
        days.workspace_id, "as_of_date").agg(
        F.avg("daily_dollars").alias("m"), F.stddev_pop("daily_dollars").alias("s"),
        F.avg(F.ln("daily_dollars")).alias("ml"), F.stddev_pop(F.ln("daily_dollars")).alias("sl"),
        F.count(F.lit(1)).alias("n"))
    a = {(r.workspace_id, r.as_of_date): r for r in fast.collect()}
    b = {(r.workspace_id, r.as_of_date): r for r in brute.collect()}
    assert a.keys() == b.keys() and len(a) > 0
    for k, r in b.items():
        f = a[k]
        assert f.baseline_n == r.n
        for x, y in [(f.baseline_mean, r.m), (f.baseline_stddev, r.s), (f.baseline_mean_log, r.ml),
                     (f.baseline_stddev_log, r.sl)]:
            assert abs(x - y) <= 1e-9 * max(1.0, abs(y))


def test_r4_one_pass_equals_bad_days_join_first_fire(mid):
    p = fx.BACKTEST_PARAMS
    hourly = mid.hourly(p)
    tiered = backtest.replay(hourly, p)
    two_pass = backtest.bad_days(hourly, p).join(backtest.first_fire(tiered, p), baseline.CLUSTER_DAY_KEYS, "left")
    two_pass = two_pass.select(*baseline.CLUSTER_DAY_KEYS, "actual_daily_dollars", "z_score", "first_alert_hour",
                               "first_critical_hour", "budget_crossed_hour", "last_active_hour",
                               backtest.outcome().alias("outcome"), backtest.lead_hours().alias("lead_hours"))
    # Sums of doubles may add up in another order.
    near = lambda df: [tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in rows(df)]
    assert near(mid.backtest(p)) == near(two_pass)


def test_rates_of_a_workspace_come_from_its_own_usage(spark):
    """Usage of further workspaces, on SKUs that workspace 1 never used, changes nothing for it."""
    i = Inputs(spark, SF_SMALL)
    other = i.usage.where("workspace_id = 2").withColumn("workspace_id", F.lit(3).cast("bigint")).withColumn(
        "sku_name", F.lit("PREMIUM_ALL_PURPOSE_COMPUTE_PHOTON"))
    own = i.usage.where("workspace_id = 1 and sku_name = 'PREMIUM_ALL_PURPOSE_COMPUTE'")
    p, keys = fx.SCORING_PARAMS, i.excluded_keys(fx.SCORING_PARAMS)

    def scored(usage_rows):
        priced = usage.priced_usage(usage_rows, i.prices, keys, p)
        rates = pricing.pricing_rates(i.card, pricing.customer_rates(priced), i.aliases, p)
        base = baseline.workspace_baseline(priced, p)
        return rows(scoring.score_inventory(i.inventory.where("workspace_id = 1"), rates, base, i.rules, p))

    assert scored(own) == scored(own.unionByName(other))


def test_streams_lose_no_row(spark):
    """Files of one arrival in any order, NULL num_workers, more workspaces."""
    from spendwatch.plans import streams
    i = Inputs(spark, SF_SMALL)
    i.__dict__["usage"] = i.usage.orderBy(F.rand(3))
    closed = rows(streams.hourly_from_usage(i, fx.BACKTEST_PARAMS).select("workspace_id", "cluster_id", "hour_ts", "dbus", "dollars"))
    batch = rows(i.hourly(fx.BACKTEST_PARAMS).select("workspace_id", "cluster_id", "hour_ts", "dbus", "dollars"))
    assert set(closed) <= set(batch) and len(batch) - len(closed) <= 10
    i = Inputs(spark, SF_SMALL)
    i.__dict__["inventory"] = i.inventory.withColumn("num_workers", F.when(F.col("num_workers") % 3 == 0, F.col("num_workers")))
    assert streams.scores_from_inventory(i, fx.SCORING_PARAMS).count() == i.scores().count()


def test_workspaces_are_independent(spark):
    i = Inputs(spark, SF_SMALL)
    full = i.scores()
    inv1 = i.inventory.where(F.col("workspace_id") == 1)
    only1 = scoring.score_inventory(inv1, i.rates_table(), i.baseline_table(), i.rules, fx.SCORING_PARAMS)
    assert rows(full.where(F.col("workspace_id") == 1)) == rows(only1)


def test_stream_restart_without_new_files_adds_nothing(spark):
    from spendwatch.streaming import scores as sm
    from spendwatch.streaming.common import run_available_now, stream_dirs
    i = Inputs(spark, SF_SMALL)
    src, out, ckpt = stream_dirs(spark, "restart-test")
    i.inventory.write.parquet(src)
    args = (spark, src, i.rates_table(), i.baseline_table(), i.rules, fx.SCORING_PARAMS, out, ckpt)
    run_available_now(sm.stream_scores(*args))
    n1 = spark.read.parquet(out).count()
    run_available_now(sm.stream_scores(*args))
    assert spark.read.parquet(out).count() == n1 == i.scores().count()


def test_price_join_fallback_equals_broadcast_on_fixture(spark):
    i = Inputs(spark, SF_SMALL)
    small = fx.USAGE_PARAMS.replace(broadcast_max_rows=0)  # forces the day-bucket shuffle join
    assert rows(i.priced(fx.USAGE_PARAMS)) == rows(i.priced(small))
    b_small = fx.BACKTEST_PARAMS.replace(broadcast_max_rows=0)
    assert rows(i.hourly(fx.BACKTEST_PARAMS)) == rows(i.hourly(b_small))


def test_scoring_alerts_and_backtest_without_broadcasts(spark):
    near = lambda df: [tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in rows(df)]
    i = Inputs(spark, SF_SMALL)
    rates, base = i.rates_table(), i.baseline_table()
    off = {"broadcast_max_rows": 0}
    both = [near(scoring.score_inventory(i.inventory, rates, base, i.rules, p)) for p in (
        fx.SCORING_PARAMS, fx.SCORING_PARAMS.replace(**off))]
    assert both[0] == both[1]
    routed = [near(alerts.route(i.alerts(p), i.directory, p)) for p in (fx.ALERT_PARAMS, fx.ALERT_PARAMS.replace(**off))]
    assert routed[0] == routed[1]
    assert near(i.backtest(fx.BACKTEST_PARAMS)) == near(i.backtest(fx.BACKTEST_PARAMS.replace(**off)))


def test_daily_tables_are_the_same_from_priced_sums(mid):
    priced = mid.priced()
    daily = usage.priced_daily(priced)
    assert set(daily.columns) == set(priced.columns)
    assert 0 < daily.count() <= priced.count()
    assert rows(pricing.customer_rates(daily)) == rows(pricing.customer_rates(priced))
    near = lambda df: [tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in rows(df)]
    assert near(baseline.workspace_baseline(daily, fx.USAGE_PARAMS)) == near(baseline.workspace_baseline(priced, fx.USAGE_PARAMS))
