"""The four jobs end to end over one table location; a second routing run
sends nothing new (suppression through the appended send log)."""

import pytest
from pyspark.sql import functions as F

from spendwatch.plans import jobs
from spendwatch.plans.inputs import Inputs
from spendwatch.session import scratch_path
from spendwatch.sources import fixtures as fx
from tests.conftest import SF_MID


def test_jobs_end_to_end(spark):
    i = Inputs(spark, SF_MID)
    t = jobs.Tables(scratch_path(spark, "tables"))
    p = fx.SCORING_PARAMS
    stats = jobs.baseline_refresh(spark, t, i.usage, i.prices, i.history, i.card, i.aliases, i.rules, p)
    assert stats["priced_rows"] == i.priced(p).count()
    assert stats["workspace_baseline_rows"] == i.baseline(p).count() and stats["pricing_rates_rows"] == i.rates(p).count()
    jobs.monitor(spark, t, i.inventory, i.rules, p)
    scores = spark.read.parquet(t.path("cluster_scores"))
    assert scores.count() == i.scores(p).count()

    ap = fx.ALERT_PARAMS.replace(critical_suppression_hours=4, warning_suppression_hours=24)
    first = jobs.route_alerts(spark, t, i.directory, ap)
    sent = sorted(map(str, first.collect()))
    assert len(sent) == i.alerts(ap).count() > 0               # empty log: everything is sent
    second = jobs.route_alerts(spark, t, i.directory, ap.replace(as_of=ap.as_of.replace(minute=30)))
    assert second.count() == 0                                 # within both suppression windows
    again = jobs.route_alerts(spark, t, i.directory, ap)      # the first run repeated
    assert sorted(map(str, again.collect())) == sent
    log = spark.read.parquet(t.path("alert_send_log"))
    assert log.count() == len(sent)
    with pytest.raises(ValueError, match="alert_channel"):
        jobs.route_alerts(spark, t, i.directory, ap.replace(alert_channel=""))

    res = jobs.run_backtest(spark, t, i.usage, i.prices, i.history, i.rules, fx.BACKTEST_PARAMS)
    assert res.count() == i.backtest().count()
    assert res.where(F.col("cluster_name").isNull()).count() == 0


def test_monitor_stops_without_a_baseline_and_outside_utc(spark):
    i = Inputs(spark, SF_MID)
    t = jobs.Tables(scratch_path(spark, "nothing-there"))
    with pytest.raises(ValueError, match="baseline"):
        jobs.monitor(spark, t, i.inventory, i.rules, fx.SCORING_PARAMS)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(ValueError, match="timeZone"):
            jobs.monitor(spark, t, i.inventory, i.rules, fx.SCORING_PARAMS)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
