"""Physical-plan targets: broadcasts where bounded, no shuffle of the big side
where none is needed, predicates and pruning reaching the parquet scan."""

import datetime as dt

from pyspark.sql import functions as F

from spendwatch.operators import backtest, sinks, usage
from spendwatch.plans.inputs import Inputs
from spendwatch.session import scratch_path
from spendwatch.sources import fixtures as fx
from tests.conftest import SF_SMALL


def physical(df):
    qe = df._jdf.queryExecution()
    plan = qe.executedPlan()
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.initialPlan()
    return plan


def walk(node):
    yield node
    children = node.children()
    for k in range(children.size()):
        yield from walk(children.apply(k))


def test_priced_usage_broadcasts_prices(spark):
    i = Inputs(spark, SF_SMALL)
    text = physical(i.priced()).toString()
    bhj = [l for l in text.splitlines() if "BroadcastHashJoin" in l and "[sku_name" in l]
    assert bhj and "usage_start_time" in bhj[0] and "_p_start" in bhj[0] and "_p_end" in bhj[0]


def test_scoring_never_shuffles_the_inventory(spark):
    i = Inputs(spark, SF_SMALL)
    plan = physical(i.scores())
    for node in walk(plan):
        if node.nodeName() == "Exchange":  # a shuffle (broadcasts are BroadcastExchange)
            assert "lineitem" not in node.toString(), node.toString()[:500]


def test_usage_scan_pushes_filters_and_prunes_partitions(spark):
    i = Inputs(spark, SF_SMALL)
    path = scratch_path(spark, "usage-table")
    i.usage.write.partitionBy("usage_date").parquet(path)
    scan = usage.usage_scan(spark.read.parquet(path), fx.USAGE_PARAMS, 10)
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        text = physical(scan).toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PartitionFilters: [isnotnull(usage_date" in text and "usage_date#" in text
    pushed = [l for l in text.splitlines() if "PushedFilters" in l]
    assert pushed and "EqualTo(billing_origin_product,ALL_PURPOSE)" in pushed[0]
    assert "IsNotNull(usage_metadata.cluster_id)" in pushed[0]


def test_alerts_latest_prunes_score_dates(spark):
    i = Inputs(spark, SF_SMALL)
    path = scratch_path(spark, "scores-table")
    sinks.write_scores(i.scores(), path)
    from spendwatch.operators import alerts
    text = physical(alerts.alerts_latest(sinks.read_scores(spark, path), fx.ALERT_PARAMS)).toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in text
    assert "WindowGroupLimit" in text


def scans(df, name):
    return physical(df).toString().count(f"/{name}.parquet")


def test_usage_is_scanned_once_and_not_shuffled_row_by_row(spark):
    i = Inputs(spark, SF_SMALL)
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        for frame in (i.priced(), i.hourly(), i.baseline(fx.USAGE_PARAMS)):
            assert scans(frame, "events") <= 1
        raw = i.backtest(fx.BACKTEST_PARAMS)
        assert scans(raw, "events") == 0  # reads the hourly aggregate that was written once
        assert scans(backtest.enrich(raw, backtest.meta_for(raw, i.history)), "events") == 0
        plan = physical(i.priced())
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    for node in walk(plan):
        if node.nodeName() == "Exchange":
            assert "events.parquet" not in node.toString(), node.toString()[:500]


def test_backtest_shuffles(spark):
    """The window and the final grouping share one partitioning; the rolling
    baseline has its own few."""
    i = Inputs(spark, SF_SMALL)
    text = physical(i.backtest(fx.BACKTEST_PARAMS)).toString()
    assert text.count("Exchange hashpartitioning(workspace_id") <= 6
    assert "BroadcastHashJoin" in text
