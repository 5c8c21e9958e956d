"""Column helpers: glob compiler, formatting, photon/worker/driver rules."""

import datetime as dt
import fnmatch
import re
import time
from decimal import Decimal

from hypothesis import given, settings, strategies as st
from pyspark.sql import Row
from pyspark.sql import functions as F

from spendwatch.functions.columns import driver_type, fmt_grouped, fmt_plain, instant, is_photon, money, worker_count
from spendwatch.functions.rules import ExclusionRules, glob_to_regex
from spendwatch.params import Params

CHARS = "ab.-#!^&\\"
_char = st.sampled_from(CHARS)
_range = st.tuples(_char, _char).map(lambda t: f"{min(t)}-{max(t)}")
_class = st.tuples(st.booleans(), st.lists(st.one_of(_char, _range), min_size=1, max_size=3)).map(
    lambda t: "[" + ("!" if t[0] else "") + "".join(t[1]).lstrip("!") + "]")
_token = st.one_of(_char.filter(lambda c: c not in "[]"), st.just("*"), st.just("?"), _class)


@settings(max_examples=500, deadline=None)
@given(st.lists(_token, max_size=5).map("".join), st.text(alphabet=CHARS + "[]", max_size=6))
def test_glob_matches_fnmatch(pattern, name):
    if "[]" in pattern or "[!]" in pattern:
        return  # "]" right after "[" is literal in globs; not generated here
    assert bool(re.match(glob_to_regex(pattern).replace("\\z", "\\Z"), name)) == fnmatch.fnmatchcase(name, pattern)


def test_glob_in_spark_matches_fnmatch(spark):
    pats = ["Supplier#0000000?4", "prod-etl-*", "[ab]x*", "[!a]*", "a.b", "*"]
    names = ["Supplier#000000014", "Supplier#000000104", "prod-etl-7", "prod-etlx", "bx", "ax", "a.b", "axb", ""]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = df.select("name", *[F.col("name").rlike(glob_to_regex(p)).alias(f"p{i}") for i, p in enumerate(pats)]).collect()
    for row in got:
        for i, p in enumerate(pats):
            assert row[f"p{i}"] == fnmatch.fnmatchcase(row["name"], p), (p, row["name"])


def test_name_reason_first_pattern_wins(spark):
    rules = ExclusionRules(name_patterns=("a*", "ab*"))
    df = spark.createDataFrame([("abc",), ("b",), (None,)], "n string")
    got = {r.n: r.reason for r in df.select("n", rules.name_reason(F.col("n")).alias("reason")).collect()}
    assert got == {"abc": "cluster_name matches pattern 'a*'", "b": None, None: None}


def test_number_formats_follow_python(spark):
    values = [0.0, 2.5, 3.5, 1234567.5, -1234.4, 999.95, 0.15, 0.25, 12.049999]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    rows = df.select("x", fmt_grouped(F.col("x"), 0).alias("g0"), fmt_plain(F.col("x"), 1).alias("p1")).collect()
    for r in rows:
        assert r.g0 == f"{r.x:,.0f}"
        assert r.p1 == f"{r.x:.1f}"


def test_inventory_columns(spark):
    schema = ("executors array<struct<node_id:string>>, num_workers int, autoscale struct<min_workers:int>, "
              "runtime_engine string, spark_version string, driver_node_type_id string, node_type_id string")
    rows = [
        ([Row(node_id="1"), Row(node_id="2")], 9, None, "PHOTON", None, None, "w"),   # executors win
        ([], 5, Row(min_workers=3), "STANDARD", "13.x-photon-scala", "", "w"),       # empty list -> num_workers
        (None, None, Row(min_workers=3), None, "13.x", "d", "w"),                      # autoscale minimum
        (None, None, Row(min_workers=None), "STANDARD", None, None, None),           # nothing -> 0
    ]
    df = spark.createDataFrame(rows, schema)
    got = df.select(worker_count().alias("w"), is_photon().alias("p"), driver_type().alias("d")).collect()
    assert [(r.w, r.p, r.d) for r in got] == [(2, True, "w"), (5, True, "w"), (3, False, "d"), (0, False, None)]


def test_long_glob_lists_keep_their_order(spark):
    rules = ExclusionRules(name_patterns=tuple(f"team-{k}-*" for k in range(10_000)) + ("team-7-x*", "*'q\\\\*"))
    df = spark.createDataFrame([("team-7-x",), ("team-9999-a",), ("nobody",), (None,), ("it'q\\\\s",)], "n string")
    got = {r.n: (r.reason, r.hit) for r in df.select(
        "n", rules.name_reason(F.col("n")).alias("reason"), rules.name_matches(F.col("n")).alias("hit")).collect()}
    assert got["team-7-x"] == ("cluster_name matches pattern 'team-7-*'", True)
    assert got["team-9999-a"] == ("cluster_name matches pattern 'team-9999-*'", True)
    assert got["nobody"] == got[None] == (None, False)


def test_instant_does_not_depend_on_the_driver_zone(spark, monkeypatch):
    want = dt.datetime(2024, 1, 31, 12, 0)
    zones = [dt.timezone.utc, dt.timezone(dt.timedelta(hours=-5))]
    for name in ("UTC", "America/New_York"):
        monkeypatch.setenv("TZ", name)
        time.tzset()
        micros = spark.range(1).select(F.unix_micros(instant(want)).alias("m")).first().m
        assert micros == int(want.replace(tzinfo=dt.timezone.utc).timestamp() * 1_000_000)
        for zone in zones:
            aware = want.replace(tzinfo=dt.timezone.utc).astimezone(zone)
            assert Params(as_of=aware).as_of == want
    monkeypatch.delenv("TZ")
    time.tzset()


def test_money_keeps_nine_decimals(spark):
    df = spark.sql("SELECT cast(0.123456789 AS decimal(38,18)) AS q, cast(0.000375 AS decimal(38,18)) AS p")
    assert df.select(money(F.col("q"), F.col("p")).alias("m")).first().m == Decimal("0.123456789") * Decimal("0.000375")
