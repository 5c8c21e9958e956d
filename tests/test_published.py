"""Versions, runs and merges of published tables."""

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from spendwatch.operators import published
from spendwatch.plans import jobs
from spendwatch.plans.inputs import Inputs
from spendwatch.session import scratch_path
from spendwatch.sources import fixtures as fx
from tests.conftest import SF_SMALL

SCHEMA = "id int, day string"


def rows(spark, values):
    return spark.createDataFrame(values, SCHEMA)


def read(spark, path):
    schema = rows(spark, []).schema
    return sorted((r.id, r.day) for r in published.current(spark, path, schema).collect())


def read_runs(spark, path):
    return sorted((r.id, r.day, r.run) for r in published.current_runs(spark, path, rows(spark, []).schema).collect())


def versions(path):
    return {n for n in os.listdir(path.removeprefix("file:")) if n.startswith("version=")}


def test_a_reader_keeps_its_version_and_old_ones_go(spark):
    path = scratch_path(spark, "published")
    assert read(spark, path) == []
    schema = rows(spark, []).schema
    bound = []
    for k in range(6):
        published.publish(rows(spark, [(k, "a"), (k, "b")]), path)
        bound.append(published.current(spark, path, schema))
        for back, frame in enumerate(reversed(bound[-published.KEEP:])):
            assert sorted(r.id for r in frame.collect()) == [k - back] * 2
    assert len(versions(path)) == published.KEEP


def test_a_failed_write_leaves_the_table_and_the_next_one_works(spark):
    path = scratch_path(spark, "published")
    published.publish(rows(spark, [(1, "a")]), path)
    broken = rows(spark, [(2, "b"), (3, "c")]).withColumn("id", F.when(F.col("id") == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("int"))
    with pytest.raises(PySparkException):
        published.publish(broken, path)
    assert read(spark, path) == [(1, "a")]
    published.publish(rows(spark, [(4, "d")]), path)
    assert read(spark, path) == [(4, "d")]


def test_a_second_writer_of_the_same_number_raises_and_shows_nothing(spark):
    path = scratch_path(spark, "published")
    published.publish(rows(spark, [(1, "a")]), path)
    version = published._write(rows(spark, [(2, "b")]), path, None)
    published.publish(rows(spark, [(3, "c")]), path)
    with pytest.raises(RuntimeError, match="another writer"):
        published._commit(spark, path, 1, [published.Part(version)])
    assert read(spark, path) == [(3, "c")]


def test_runs_count_once_before_and_after_merges(spark):
    path = scratch_path(spark, "runs")
    want = {}
    for k in range(14):
        run = f"r{k:02d}"
        want[run] = [(k, "x"), (k, "y")]
        published.append_run(rows(spark, want[run]), path, run, "day", fan=2)
    for run, values in (("r01", [(100, "x")]), ("r13", [(113, "z")]), ("r01", [(101, "y")]), ("r05", [])):
        want[run] = values
        published.append_run(rows(spark, values), path, run, "day", fan=2)
        assert read_runs(spark, path) == sorted((i, d, r) for r, v in want.items() for i, d in v)
    levels = [p.level for p in published.parts(spark, path)]
    assert len(levels) <= 8 and max(levels) >= 2
    for level in set(levels):
        assert levels.count(level) <= 2


def test_monitor_twice_with_one_as_of_is_one_run(spark):
    i = Inputs(spark, SF_SMALL)
    t = jobs.Tables(scratch_path(spark, "tables"))
    p = fx.SCORING_PARAMS
    jobs.baseline_refresh(spark, t, i.usage, i.prices, i.history, i.card, i.aliases, i.rules, p)
    inventory = i.inventory.where("snapshot_ts between '1998-01-01' and '1998-02-01'")
    first, second = inventory.where("snapshot_ts < '1998-01-16'"), inventory.where("snapshot_ts >= '1998-01-16'")
    jobs.monitor(spark, t, first, i.rules, p)
    jobs.monitor(spark, t, first, i.rules, p)
    n = jobs.read_scores(spark, t).count()
    later = p.replace(as_of=p.as_of.replace(minute=15))
    jobs.monitor(spark, t, second, i.rules, later)
    jobs.monitor(spark, t, first, i.rules, p)
    whole = i.scores(p).where("snapshot_ts between '1998-01-01' and '1998-02-01'")
    assert 0 < n < jobs.read_scores(spark, t).count() == whole.count()
