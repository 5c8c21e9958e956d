"""Ends of alerts and complete hours against plain loops."""

import datetime as dt
import random

from spendwatch.params import Params
from spendwatch.plans import streams
from spendwatch.plans.inputs import Inputs
from spendwatch.session import scratch_path
from spendwatch.sources import fixtures as fx
from spendwatch.streaming import resolve
from spendwatch.streaming.common import run_available_now
from tests.conftest import SF_SMALL

START = dt.datetime(2024, 1, 1)
SCHEMA = "workspace_id long, cluster_id string, signal string, snapshot_ts timestamp"


def ends(rows, recency, until):
    out, last = [], {}
    for at in sorted({r[3] for r in rows}) + [None]:
        for key in sorted({r[:2] for r in rows}):
            own = sorted(r[2] for r in rows if r[:2] == key and r[3] == at)
            if key in last and ((at is None and last[key] + recency < until) or (own and at > last[key] + recency)):
                out.append((*key, last.pop(key) + recency, "silent"))
            if own and own[0] in ("WARNING", "CRITICAL"):  # of one time, the first signal by name
                last[key] = at
            elif own and key in last:
                out.append((*key, at, "recovered"))
                del last[key]
    return sorted(out)


def test_resolved_alerts_over_arrivals_and_restarts(spark):
    rng = random.Random(6)
    p = Params(alert_recency=dt.timedelta(minutes=30))
    rows = sorted({(1, f"c{rng.randrange(6)}", rng.choice(["OK", "WARNING", "CRITICAL", "EXCLUDED"]), START + dt.timedelta(minutes=15 * rng.randrange(200)))
                   for _ in range(300)} | {(2, "edge", "WARNING", START), (2, "edge", "WARNING", START + dt.timedelta(minutes=30)),
                                           (2, "gone", "CRITICAL", START + dt.timedelta(minutes=15 * 199))}, key=lambda r: r[3])
    schema = spark.createDataFrame([], SCHEMA).schema
    src, out, ckpt = (scratch_path(spark, n) for n in ("in", "out", "ckpt"))
    for k in range(3):
        spark.createDataFrame(rows[k * len(rows) // 3:(k + 1) * len(rows) // 3], SCHEMA).repartition(2).write.mode("append").parquet(src)
        run_available_now(resolve.stream_resolved(spark, src, schema, out, p, ckpt))
    got = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    until = max(r[3] for r in rows) - dt.timedelta(hours=2)
    assert got == ends(rows, p.alert_recency, until)
    assert {r[3] for r in got} == {"silent", "recovered"}


def test_late_and_open_hours_come_from_the_ledger(spark):
    i = Inputs(spark, SF_SMALL)
    got = streams.hourly_with_corrections(i, fx.BACKTEST_PARAMS)
    want = i.hourly(fx.BACKTEST_PARAMS)
    columns = ["workspace_id", "usage_date", "hour_ts", "hour_of_day", "cluster_id", "dbus", "dollars"]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, want.select(columns).collect()))


def test_arrivals_have_more_files_and_not_larger_ones(spark, monkeypatch):
    rows = spark.range(20_000).selectExpr("id", "xxhash64(id) AS x")
    table, few, many = (scratch_path(spark, n) for n in ("table", "few", "many"))
    rows.write.parquet(table)
    streams._arrive(spark.read.parquet(table), few)
    monkeypatch.setattr(streams, "FILE_BYTES", 10_000)
    streams._arrive(spark.read.parquet(table), many)
    assert len(spark.read.parquet(few).inputFiles()) == streams.FILES and len(spark.read.parquet(many).inputFiles()) > 15
    assert spark.read.parquet(many).distinct().count() == 20_000


def test_streams_score_the_inventory_once(spark, monkeypatch):
    """Each stream feeds its arrivals from one written table, not from a plan run again for every arrival."""
    read = []
    own = streams._arrive
    monkeypatch.setattr(streams, "_arrive", lambda part, path: (read.append(part.inputFiles()), own(part, path)))
    for run, p in ((streams.scores_from_inventory, fx.SCORING_PARAMS), (streams.suppression_from_alerts, fx.ALERT_PARAMS),
                   (streams.sends_from_history, fx.ALERT_PARAMS), (streams.resolved_from_scores, fx.RESOLVE_PARAMS)):
        read.clear()
        run(Inputs(spark, SF_SMALL), p)
        assert len(read) > 1 and all("-once-" in f for files in read for f in files)
