"""Hand-made goldens for every branch (tiny literal frames)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from spendwatch import schemas as S
from spendwatch.functions.rules import ExclusionRules
from spendwatch.operators import alerts, baseline, joins, pricing, scoring
from spendwatch.params import Params

T0 = dt.datetime(2024, 1, 10)


def prices_df(spark):
    rows = [("SKU", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 10), Decimal("0.50")),
            ("SKU", dt.datetime(2024, 1, 10), None, Decimal("0.70"))]
    raw = spark.createDataFrame(rows, "sku_name string, s timestamp, e timestamp, price decimal(18,2)")
    return raw.select("sku_name", F.col("s").alias("price_start_time"), F.col("e").alias("price_end_time"),
                      F.struct(F.col("price").alias("default")).alias("pricing"))


@pytest.mark.parametrize("max_rows", [1000, 0])  # broadcast path and bucketed shuffle path
def test_price_interval_boundaries(spark, max_rows):
    usage = spark.createDataFrame(
        [(1, "SKU", dt.datetime(2023, 12, 31, 23, 59)),      # before any price -> unpriced
         (2, "SKU", dt.datetime(2024, 1, 1)),                # start instant is inside
         (3, "SKU", T0 - dt.timedelta(microseconds=1)),      # last instant of the first interval
         (4, "SKU", T0),                                     # end is exclusive -> next interval
         (5, "SKU", dt.datetime(2030, 5, 5)),                # open end
         (6, "OTHER", T0)],                                  # no price for the sku
        "id int, sku_name string, usage_start_time timestamp")
    lo, hi = dt.date(2024, 1, 1), dt.date(2024, 1, 31)
    got = {r.id: r.dollars_per_dbu for r in joins.price_join(usage, prices_df(spark), "left", lo, hi, max_rows).collect()}
    assert got == {1: None, 2: Decimal("0.50"), 3: Decimal("0.50"), 4: Decimal("0.70"), 5: Decimal("0.70"), 6: None}
    inner = joins.price_join(usage, prices_df(spark), "inner", lo, hi, max_rows)
    assert sorted(r.id for r in inner.collect()) == [2, 3, 4, 5]


def rates_df(spark):
    rows = [(1, "AWS", "m.large", "All-Purpose Compute", False, "STD", 1.0, 0.5, 0.5, None),
            (1, "AWS", "m.large", "All-Purpose Compute Photon", True, "PH", 2.0, 0.6, 1.2, None),
            (1, "AWS", "r.large", "All-Purpose Compute", False, "STD", 3.0, 0.5, 1.5, None),   # no photon row
            (1, "AWS", "r.large", "All-Purpose Compute", False, "STD", 2.5, 0.5, 1.25, None)]  # duplicate: max wins
    return spark.createDataFrame(rows, S.PRICING_RATES)


def baseline_df(spark, mu=3.0, sd=1.0, ws=1):
    return spark.createDataFrame(
        [(ws, dt.datetime(2024, 1, 31), 30, 10, 40.0, 20.0, 30.0, 60.0, 70.0, 90.0, 100.0, mu, sd)],
        S.WORKSPACE_BASELINE)


def inv_row(cid, node="m.large", drv=None, workers=1, engine="STANDARD", name="c", creator="u@x.com",
            state="RUNNING", source="UI", ws=1):
    return (ws, T0, cid, name, creator, node, drv, None, engine, state, source, workers, None, None)


def score(spark, rows, p=Params(budget_daily_dollars=100.0), rules=ExclusionRules(), bl=None):
    inv = spark.createDataFrame(rows, S.INVENTORY)
    out = scoring.score_inventory(inv, rates_df(spark), bl if bl is not None else baseline_df(spark), rules, p)
    return {r.cluster_id: r for r in out.collect()}


def test_scoring_branches(spark):
    rows = [
        inv_row("ok", workers=0),                               # 0.5 $/h -> 12 $/day
        inv_row("fallback", node="r.large", engine="PHOTON"),   # photon missing -> standard rate (max 1.5)
        inv_row("unknown", node="x.large"),
        inv_row("budget", workers=10),                          # (0.5 + 10*0.5) * 24 = 132 > 100
        inv_row("stopped", state="TERMINATED"),
        inv_row("job", source="JOB"),
    ]
    got = score(spark, rows)
    assert set(got) == {"ok", "fallback", "unknown", "budget"}
    assert got["ok"].signal == "OK" and got["ok"].reason == "within thresholds"
    assert got["ok"].projected_daily_dollars == pytest.approx(12.0)
    assert got["fallback"].dbu_per_hour == pytest.approx(6.0) and got["fallback"].sku_name == "PH"
    assert got["unknown"].signal == "UNKNOWN"
    assert got["unknown"].reason == "Missing pricing for driver=x.large worker=x.large photon=False"
    assert got["unknown"].projected_daily_dollars is None and got["unknown"].z_score is None
    assert got["budget"].signal == "CRITICAL"
    assert got["budget"].reason.startswith("projected_daily $132 > budget $100")


def test_z_tiers_and_guards(spark):
    p = Params(budget_daily_dollars=1e9)
    # mu = ln(12): a 12 $/day cluster has z = 0; 12 * e^2.5 -> WARNING; 12 * e^3.5 -> CRITICAL
    import math
    bl = baseline_df(spark, mu=math.log(12.0), sd=1.0)
    rows = [inv_row("zero", workers=0),
            inv_row("warn", workers=int(math.exp(2.5) * 1 - 1) + 1),
            inv_row("crit", workers=int(math.exp(3.5)) + 1)]
    got = score(spark, rows, p=p, bl=bl)
    assert got["zero"].z_score == pytest.approx(0.0) and got["zero"].signal == "OK"
    assert got["warn"].signal == "WARNING" and "> warning 2.0" in got["warn"].reason
    assert got["crit"].signal == "CRITICAL" and "> critical 3.0" in got["crit"].reason
    # NULL sigma and zero projection both give a NULL z (and no division by zero under ANSI).
    got = score(spark, [inv_row("a")], p=p, bl=baseline_df(spark, mu=None, sd=None))
    assert got["a"].z_score is None and got["a"].signal == "OK"
    zero_rates = rates_df(spark).withColumn("dollars_per_hour", F.lit(0.0))
    inv = spark.createDataFrame([inv_row("z")], S.INVENTORY)
    out = scoring.score_inventory(inv, zero_rates, baseline_df(spark), ExclusionRules(), p).collect()[0]
    assert out.projected_daily_dollars == 0.0 and out.z_score is None and out.signal == "OK"


def test_exclusion_priority(spark):
    rules = ExclusionRules(ids=("both",), name_patterns=("prod-*", "prod-etl-*"), creators=("svc@x.com",))
    rows = [inv_row("both", name="prod-etl-1", creator="svc@x.com"),
            inv_row("named", name="prod-etl-1", creator="svc@x.com"),
            inv_row("owner", name="adhoc", creator="svc@x.com"),
            inv_row("free", name="adhoc", node="x.large")]
    got = score(spark, rows, rules=rules)
    assert got["both"].reason == "cluster_id both in exclusion rules"
    assert got["named"].reason == "cluster_name matches pattern 'prod-*'"
    assert got["owner"].reason == "creator svc@x.com in exclusion rules"
    assert all(got[c].signal == "EXCLUDED" and got[c].projected_daily_dollars is None for c in ("both", "named", "owner"))
    assert got["free"].signal == "UNKNOWN"  # exclusion is checked before missing pricing


def test_suppression_boundary(spark):
    as_of = dt.datetime(2024, 2, 1, 12, 0)
    p = Params(as_of=as_of, critical_suppression_hours=4, warning_suppression_hours=24)
    al = spark.createDataFrame(
        [(1, "a", "CRITICAL", 1.0), (1, "b", "CRITICAL", 1.0), (1, "c", "WARNING", 1.0), (1, "d", "WARNING", 1.0),
         (2, "a", "CRITICAL", 1.0)],
        "workspace_id long, cluster_id string, signal string, projected_daily_dollars double")
    T = dt.timedelta
    log = spark.createDataFrame(
        [(as_of - T(hours=4), 1, "a", "CRITICAL", "#c", "channel_only", None),            # exactly T: suppressed
         (as_of - T(hours=4, microseconds=1), 1, "b", "CRITICAL", "#c", "channel_only", None),  # older: send
         (as_of - T(hours=5), 1, "c", "WARNING", "#c", "channel_only", None),           # within 24h: suppressed
         (as_of - T(hours=5), 1, "d", "CRITICAL", "#c", "channel_only", None)],         # other tier: send
        S.SEND_LOG)
    got = sorted((r.workspace_id, r.cluster_id) for r in alerts.alerts_to_send(al, log, p).collect())
    assert got == [(1, "b"), (1, "d"), (2, "a")]


def test_weekdays_only(spark):
    days = [dt.date(2024, 1, d) for d in range(1, 8)]  # Mon .. Sun
    df = spark.createDataFrame([(d,) for d in days], "usage_date date")
    assert [r.usage_date.isoweekday() for r in baseline.weekdays_only(df).collect()] == [1, 2, 3, 4, 5]


def test_rate_fallback_table(spark):
    got = {(r.node_type, r.photon): r.dbu_per_hour for r in pricing.rates_with_fallback(rates_df(spark)).collect()}
    assert got == {("m.large", False): 1.0, ("m.large", True): 2.0, ("r.large", False): 3.0, ("r.large", True): 3.0}


def test_fleet_alias_expansion(spark):
    rows = spark.createDataFrame([("r5d.xlarge", "All-Purpose Compute", False, 1.0),
                                  ("r5dx.large", "All-Purpose Compute", False, 2.0),
                                  ("r5d", "All-Purpose Compute", False, 3.0)],
                                 "node_type string, workload string, photon boolean, dbu_per_hour double")
    aliases = spark.createDataFrame([("rd-fleet", "r5d")], S.FLEET_ALIASES)
    got = sorted(r.node_type for r in pricing.expand_aliases(rows, aliases).collect())
    assert got == ["r5d", "r5d.xlarge", "r5dx.large", "rd-fleet.xlarge"]


def test_message_rendering(spark):
    p = Params(routing_mode="dm_with_fallback", alert_channel="#cost", workspace_host="https://h.example.com/x")
    al = spark.createDataFrame(
        [(1, "c1", "n1", " o@x.com ", 2500.0, "CRITICAL"), (1, "c2", "n2", "nobody", 10.0, "WARNING"),
         (1, "c3", None, None, None, "WARNING")],
        "workspace_id long, cluster_id string, cluster_name string, creator string, "
        "projected_daily_dollars double, signal string")
    directory = spark.createDataFrame([("o@x.com", "U1234567")], S.DIRECTORY)
    routed = alerts.route(al, directory, p)
    out = {r.cluster_id: r for r in alerts.render(routed, baseline_df(spark), p).collect()}
    assert (out["c1"].recipient, out["c1"].routing) == ("U1234567", "dm")
    assert out["c1"].headline == ":rotating_light: Cluster Cost Alert (CRITICAL)"
    assert out["c1"].plain == "CRITICAL: cluster n1 projected at $2,500/day (6,150% above average)"
    assert out["c1"].body.startswith("Hi <@U1234567>, your all-purpose compute cluster *n1*")
    assert out["c1"].link == "https://h.example.com/compute/clusters/c1"
    assert (out["c2"].recipient, out["c2"].routing) == ("#cost", "fallback_channel")
    assert out["c2"].body.startswith("Hi team — cluster owned by `nobody`: their")
    assert out["c2"].plain == "WARNING: cluster n2 projected at $10/day (-75% above average)"
    assert out["c3"].plain == "WARNING: cluster None projected at ?/day (? above average)"
    assert "_unknown owner_" in out["c3"].body


def test_recency_is_inclusive_and_heartbeat_strict(spark):
    as_of = dt.datetime(2024, 2, 1, 12, 0)
    p = Params(as_of=as_of, alert_recency=dt.timedelta(minutes=30))
    edge = as_of - dt.timedelta(minutes=30)

    def row(ws, cid, ts, signal):
        return (ws, ts, ts.date(), cid, "n", "o@x.com", "UI", "m.large", "m.large", 1, False, "S",
                1.0, 1.0, 24.0, 1.0, 1.0, 3.5, signal, "r")

    scores = spark.createDataFrame([
        row(1, "edge", edge, "CRITICAL"),                                   # exactly at the cutoff: kept
        row(1, "old", edge - dt.timedelta(microseconds=1), "WARNING"),      # just older: dropped
        row(1, "healed", edge + dt.timedelta(minutes=1), "WARNING"),
        row(1, "healed", edge + dt.timedelta(minutes=5), "OK"),             # latest row is OK: no alert
        row(2, "w2", edge - dt.timedelta(hours=1), "CRITICAL"),
    ], S.CLUSTER_SCORES)
    assert sorted(r.cluster_id for r in alerts.alerts_latest(scores, p).collect()) == ["edge"]
    beat = {r.workspace_id: r.stale for r in alerts.heartbeat(scores, p).collect()}
    assert beat == {1: False, 2: True}
