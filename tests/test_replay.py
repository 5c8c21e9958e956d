"""The suppression replay and its stream against a loop over each key."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from spendwatch.operators import replay
from spendwatch.params import Params
from spendwatch.session import scratch_path
from spendwatch.streaming import suppression
from spendwatch.streaming.common import run_available_now

P = Params(warning_suppression_hours=24, critical_suppression_hours=4)
START = dt.datetime(2024, 1, 1)
SCHEMA = "workspace_id long, cluster_id string, signal string, snapshot_ts timestamp"


def loop(rows, log=()):
    last, out = {}, []
    for ws, cluster, signal, at in log:
        last[ws, cluster, signal] = max(at, last.get((ws, cluster, signal), at))
    for ws, cluster, signal, at in sorted(set(rows), key=lambda r: r[3]):
        hours = {"CRITICAL": 4, "WARNING": 24}.get(signal)
        if hours and ((ws, cluster, signal) not in last or at > last[ws, cluster, signal] + dt.timedelta(hours=hours)):
            last[ws, cluster, signal] = at
            out.append((ws, cluster, signal, at))
    return sorted(out)


def history(seed, n=400, days=12):
    rng = random.Random(seed)
    rows = [(rng.randrange(1, 3), f"c{rng.randrange(4)}", rng.choice(["WARNING", "CRITICAL", "OK"]),
             START + dt.timedelta(minutes=15 * rng.randrange(days * 96))) for _ in range(n)]
    # On the edge of the window, before and after the epoch, and exact repeats.
    edge = [(3, "edge", "CRITICAL", START + dt.timedelta(hours=4 * k)) for k in range(6)]
    beyond = [(3, "beyond", "CRITICAL", START + dt.timedelta(hours=4 * k, microseconds=k)) for k in range(6)]
    old = [(4, "old", "WARNING", dt.datetime(1969, 12, 30) + dt.timedelta(hours=7 * k)) for k in range(20)]
    return rows + edge + beyond + old + rows[:50]


@pytest.mark.parametrize("seed", [1, 2])
def test_sends_over_history_equal_the_loop(spark, seed):
    rows = history(seed)
    got = replay.sends_over_history(spark.createDataFrame(rows, SCHEMA).repartition(4), P).collect()
    assert sorted(map(tuple, got)) == loop(rows)


def test_no_alerts(spark):
    assert replay.sends_over_history(spark.createDataFrame([(1, "a", "OK", START)], SCHEMA), P).collect() == []


def test_successor_groups_are_bounded_by_time(spark):
    """A hot key's alerts are ranked by key and window length, not by key alone."""
    hot = spark.range(50_000).select(F.lit(1).cast("long").alias("workspace_id"), F.lit("hot").alias("cluster_id"), F.lit("CRITICAL").alias("signal"),
                                     (F.lit(START) + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("snapshot_ts"))
    got = replay.sends_over_history(hot, P)
    assert got.count() == -(-50_000 // 241)
    assert got.select(F.countDistinct(F.unix_micros("sent_at") % 60_000_000)).first()[0] == 1


def test_stream_equals_the_replay_over_arrivals_and_restarts(spark):
    rows = sorted(set(history(3)), key=lambda r: r[3])
    src, out, ckpt = (scratch_path(spark, n) for n in ("in", "out", "ckpt"))
    log = [(1, "c0", "WARNING", START - dt.timedelta(hours=1)), (1, "c0", "WARNING", START - dt.timedelta(hours=30)),
           (2, "c1", "CRITICAL", START - dt.timedelta(hours=3))]
    logged = spark.createDataFrame(log, "workspace_id long, cluster_id string, signal string, sent_at timestamp")
    rows = [r for r in rows if r[3] >= START]
    schema = spark.createDataFrame([], SCHEMA).schema
    for k in range(4):
        part = rows[k * len(rows) // 4:(k + 1) * len(rows) // 4]
        spark.createDataFrame(part, SCHEMA).repartition(3).write.mode("append").parquet(src)
        run_available_now(suppression.stream_sends(spark, src, schema, out, P, ckpt, logged))
    got = spark.read.schema(schema).parquet(out).collect()
    assert sorted(map(tuple, got)) == loop(rows, log) != loop(rows)
    # The store holds only keys whose last send is within its window of the watermark.
    state = spark.read.format("statestore").option("stateVarName", "sent").load(ckpt)
    newest = max(r[3] for r in rows) - dt.timedelta(hours=2)
    live = {r[:3] for r in got if r[3] + dt.timedelta(hours=4 if r[2] == "CRITICAL" else 24) > newest - dt.timedelta(hours=24)}
    assert 0 < state.count() <= len(live) < len({r[:3] for r in got})
