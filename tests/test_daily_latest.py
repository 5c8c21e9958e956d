"""Stored daily moments and the table of newest scores."""

import datetime as dt
import random

import pytest

from spendwatch.operators import alerts, baseline, daily, latest, published
from spendwatch.params import Params
from spendwatch.session import scratch_path

P = Params(as_of=dt.datetime(2024, 3, 1), baseline_lookback_days=3, weekend_baseline=True)
START = dt.date(2024, 1, 1)
TOTALS = "workspace_id long, usage_date date, cluster_id string, daily_dollars double"


def totals(spark, days, seed=1):
    rng = random.Random(seed)
    rows = []
    for d in days:
        for ws in (1, 2):
            # The second workspace has days without usage and days without positive spend.
            for c in range(rng.randrange(0, 4) if ws == 2 else 3):
                rows.append((ws, START + dt.timedelta(days=d), f"c{c}", float(rng.choice([0, 1, 7, 1000])) if ws == 2 else rng.random() * 50))
    return spark.createDataFrame(rows, TOTALS)


def close(rows):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows)


def test_days_added_one_by_one_equal_a_rebuild_and_read_their_window_only(spark):
    path = scratch_path(spark, "moments")
    full = totals(spark, range(6))
    whole = close(tuple(r) for r in baseline.rolling_baseline(full, P).collect())
    got = []
    for d in range(6):
        day = START + dt.timedelta(days=d)
        daily.add_days(full.where(full.usage_date == day), path, f"{day}", P)
        got += daily.baselines_between(spark, path, day, day, P).collect()
    assert close(tuple(r) for r in got) == whole
    last = START + dt.timedelta(days=5)
    plan = daily.baselines_between(spark, path, last, last, P)._jdf.queryExecution().executedPlan().toString()
    assert ">= 2024-01-03)" in plan and "<= 2024-01-06)" in plan and "GreaterThanOrEqual(usage_date,2024-01-03)" in plan


def test_a_day_that_is_repeated_after_runs_were_merged_is_replaced(spark, monkeypatch):
    monkeypatch.setattr(published.append_run, "__defaults__", (None, 2, None))
    path = scratch_path(spark, "moments")
    full = totals(spark, range(6), seed=2)
    for d in range(6):
        day = START + dt.timedelta(days=d)
        rows = full.where(full.usage_date == day)
        daily.add_days(rows.where(rows.cluster_id == "c0") if d == 1 else rows, path, f"{day}", P)
    second = START + dt.timedelta(days=1)
    daily.add_days(full.where(full.usage_date == second), path, f"{second}", P)
    got = daily.baselines_between(spark, path, START, START + dt.timedelta(days=5), P).collect()
    assert close(tuple(r) for r in got) == close(tuple(r) for r in baseline.rolling_baseline(full, P).collect())


def test_no_days(spark):
    path = scratch_path(spark, "moments")
    assert daily.baselines_between(spark, path, START, START, P).count() == 0
    daily.add_days(totals(spark, range(1)).where("false"), path, "none", P)
    assert daily.baselines_between(spark, path, START, START, P).count() == 0


@pytest.mark.parametrize("fan", [2, 32])
def test_newest_scores_over_late_and_repeated_polls(spark, fan):
    rng = random.Random(fan)
    schema = "workspace_id long, cluster_id string, snapshot_ts timestamp, signal string, reason string"
    polls = {f"{k:02d}": [(rng.randrange(2), f"c{rng.randrange(9)}", dt.datetime(2024, 1, 1, k, rng.randrange(3)),
                           rng.choice(["OK", "WARNING"]), rng.choice([None, "x"])) for _ in range(7)] for k in range(9)}
    path = scratch_path(spark, "latest")
    order = ["00", "02", "03", "01", "04", "05", "05", "06", "07", "03", "08"]
    for poll in order:
        latest.add_poll(spark.createDataFrame(polls[poll], schema), path, poll, fan)
    every = spark.createDataFrame([r for rows in polls.values() for r in rows], schema)
    expected = alerts.latest_by(every, alerts.KEYS, alerts.score_order(every.columns))
    got = latest.latest_state(spark, path, every.schema)
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
    held = published.current_runs(spark, path, every.schema).count()
    if fan == 2:
        assert held < sum(len(set((r[0], r[1]) for r in rows)) for rows in polls.values())
        assert len(published.parts(spark, path)) <= 2 * 4
