"""Distributed exact percentiles equal SQL PERCENTILE."""

import random

from pyspark.sql import functions as F

from spendwatch.operators.stats import exact_percentiles, percentiles_of_few

PROBS = {"p10": 0.1, "p50": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99, "p0": 0.0, "p100": 1.0}


def test_matches_builtin_percentile(spark):
    rng = random.Random(7)
    rows = []
    for g in range(5):
        n = [1, 2, 17, 400, 3000][g]
        for _ in range(n):
            kind = rng.random()
            v = (round(rng.lognormvariate(3, 1.3), 4) if kind < 0.7 else
                 float(rng.randint(-3, 3)) if kind < 0.9 else 1234.5678)  # duplicates, zero, negatives
            rows.append((g, v))
    df = spark.createDataFrame(rows, "g int, v double")
    ours = {r.g: r for r in exact_percentiles(df, ["g"], "v", PROBS).collect()}
    ref = df.groupBy("g").agg(*[F.percentile("v", p).alias(k) for k, p in PROBS.items()]).collect()
    for r in ref:
        for k in PROBS:
            assert abs(ours[r.g][k] - r[k]) <= 1e-9 * max(1.0, abs(r[k])), (r.g, k, ours[r.g][k], r[k])


def test_null_values_ignored_and_empty_group_absent(spark):
    df = spark.createDataFrame([(1, None), (1, 5.0), (2, None)], "g int, v double")
    got = {r.g: r.p50 for r in exact_percentiles(df, ["g"], "v", {"p50": 0.5}).collect()}
    assert got == {1: 5.0}


def test_few_values_match_builtin_percentile(spark):
    rng = random.Random(3)
    rows = [(g, rng.choice([None, *range(-2, 24)])) for g in range(4) for _ in range([1, 2, 60, 900][g])] + [(9, None), (8, 7)]
    df = spark.createDataFrame(rows, "g int, v int").repartition(3)
    ours = {r.g: r for r in percentiles_of_few(df, ["g"], "v", PROBS).collect()}
    ref = df.groupBy("g").agg(*[F.percentile("v", p).alias(k) for k, p in PROBS.items()]).where("p50 is not null").collect()
    assert {r.g for r in ref} == set(ours)
    for r in ref:
        assert [ours[r.g][k] for k in PROBS] == [r[k] for k in PROBS]
