"""Domain tables derived from the generated test tables.

The mappings are the ones in FIXTURES.md; the DuckDB oracle derives the same
tables with the same rules (see ``spendwatch.plans.oracle``).  Only three tiny
rule tables are literal; every other table is computed from the test data so
the work grows with the scale factor.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendwatch import schemas as S
from spendwatch.functions.columns import instant
from spendwatch.functions.rules import ExclusionRules
from spendwatch.params import Params
from spendwatch.session import local_frame
from spendwatch.sources.readers import read_table

# Fixed values of the test fixture ------------------------------------------
# event_type -> sku_name
EVENT_SKUS = {
    "click": "PREMIUM_ALL_PURPOSE_COMPUTE",
    "view": "PREMIUM_ALL_PURPOSE_COMPUTE_PHOTON",
    "purchase": "premium_all_purpose_compute_photon_eu",
    "signup": "PREMIUM_JOBS_COMPUTE",
    "error": "PREMIUM_ALL_PURPOSE_SERVERLESS",
}
# (sku_name, price_start_time, price_end_time or None, $/DBU)
PRICE_ROWS = [
    ("PREMIUM_ALL_PURPOSE_COMPUTE", "2023-01-01 00:00:00", "2024-01-16 00:00:00", "0.55"),
    ("PREMIUM_ALL_PURPOSE_COMPUTE", "2024-01-16 00:00:00", None, "0.60"),
    ("PREMIUM_ALL_PURPOSE_COMPUTE_PHOTON", "2023-01-01 00:00:00", None, "0.65"),
    ("PREMIUM_JOBS_COMPUTE", "2023-01-01 00:00:00", None, "0.15"),
    # Overlaps the open interval above for two days.
    ("PREMIUM_ALL_PURPOSE_COMPUTE_PHOTON", "2024-01-10 06:00:00", "2024-01-12 06:00:00", "0.70"),
]
FLEET_ALIAS_ROWS = [("blue-fleet", "blue"), ("old-fleet", "old")]
TEST_RULES = ExclusionRules(ids=("7",), name_patterns=("Supplier#0000000?4",), creators=("owner_3@example.com",))
PREMIUM_BRANDS = ("Brand#1", "Brand#2", "Brand#3")
# ---------------------------------------------------------------------------


def _ts(c) -> Column:
    """Test tables carry TIMESTAMP_NTZ; the pipeline works on UTC instants."""
    return F.col(c).cast("timestamp") if isinstance(c, str) else c.cast("timestamp")


def _ws(key: str) -> Column:
    return (F.lit(1) + F.col(key) % 2).cast("bigint")


def _dotted(name_col: str) -> Column:
    return F.regexp_replace(F.col(name_col), " ", ".")


def usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    ts = _ts("ts")
    sku = F.lit(None).cast("string")
    for event_type, name in reversed(list(EVENT_SKUS.items())):
        sku = F.when(F.col("event_type") == event_type, F.lit(name)).otherwise(sku)
    return ev.select(
        _ws("user_id").alias("workspace_id"),
        F.to_date(ts).alias("usage_date"),
        ts.alias("usage_start_time"),
        F.struct(F.col("user_id").cast("string").alias("cluster_id")).alias("usage_metadata"),
        sku.alias("sku_name"),
        F.when(F.col("event_type") == "signup", "JOBS").otherwise("ALL_PURPOSE").alias("billing_origin_product"),
        F.col("value").cast(S.MONEY).alias("usage_quantity"),
    )


def prices(spark: SparkSession) -> DataFrame:
    rows = [(sku, start, end, Decimal(price)) for sku, start, end, price in PRICE_ROWS]
    raw = local_frame(spark, rows, "sku_name string, s string, e string, price decimal(18,2)")
    return raw.select(
        "sku_name",
        F.to_timestamp("s").alias("price_start_time"),
        F.to_timestamp("e").alias("price_end_time"),
        F.struct(F.col("price").alias("default")).alias("pricing"),
    )


def clusters_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        _ws("o_custkey").alias("workspace_id"),
        F.col("o_custkey").cast("string").alias("cluster_id"),
        F.concat(F.lower("o_orderpriority"), F.lit("-"), F.col("o_custkey").cast("string")).alias("cluster_name"),
        F.concat(F.lit("owner_"), (F.col("o_custkey") % 25).cast("string"), F.lit("@example.com")).alias("owned_by"),
        _ts("o_orderdate").alias("change_time"),
        F.col("o_orderkey").alias("change_seq"),
    )


def rate_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    photon_size = (F.col("p_size") % 4) == 0
    # Some instances are spelled with underscores; those of family "new" are
    # under a name that the inventory does not use, so they have no price.
    dotted = _dotted("p_name")
    inst = F.when(F.col("p_size") % 7 == 3, F.regexp_replace(dotted, "[.]", "_.")).otherwise(
        F.regexp_replace(dotted, "^new[.]", "renamed."))
    return p.select(
        F.when(photon_size, F.concat(inst, F.lit(" (Photon)"))).otherwise(inst).alias("instance"),
        F.when(F.col("p_type") == "SMALL", "Jobs Compute")
        .when(photon_size, "All-Purpose Compute Photon")
        .otherwise("All-Purpose Compute").alias("compute"),
        F.when(F.col("p_brand").isin(*PREMIUM_BRANDS), "Premium").otherwise("Enterprise").alias("plan"),
        (F.col("p_size") / 10.0).alias("dburate"),
    )


def fleet_aliases(spark: SparkSession) -> DataFrame:
    return local_frame(spark, FLEET_ALIAS_ROWS, S.FLEET_ALIASES)


def _inventory_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    part = read_table(spark, sf_dir, "part").select(
        F.col("p_partkey"), _dotted("p_name").alias("node_name"))
    drv = read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("drv_partkey"), _dotted("p_name").alias("drv_name"))
    sup = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return (li.join(part, li.l_partkey == part.p_partkey, "left")
            .join(sup, li.l_suppkey == sup.s_suppkey, "left")
            .join(drv, li.l_suppkey == drv.drv_partkey, "left"))


def _inventory_columns() -> list[Column]:
    line3 = F.col("l_linenumber") % 3
    owner = F.concat(F.lit("owner_"), F.col("s_nationkey").cast("string"), F.lit("@example.com"))
    return [
        _ws("l_suppkey").alias("workspace_id"),
        F.timestamp_add("MINUTE", F.col("l_linenumber") * 15, _ts("l_shipdate")).alias("snapshot_ts"),
        F.col("l_suppkey").cast("string").alias("cluster_id"),
        F.col("s_name").alias("cluster_name"),
        # Of every five owners one is padded and one is no e-mail address.
        F.when(F.col("s_nationkey") % 5 == 1, F.concat(F.lit("  "), owner, F.lit(" ")))
        .when(F.col("s_nationkey") % 5 == 2, F.concat(F.lit("service-"), F.col("s_nationkey").cast("string")))
        .otherwise(owner).alias("creator_user_name"),
        F.col("node_name").alias("node_type_id"),
        F.when(line3 == 0, F.col("drv_name")).when(line3 == 1, F.lit("")).alias("driver_node_type_id"),
        F.when(F.col("l_linenumber") == 5, "15.4.x-Photon-scala2.12").when(F.col("l_linenumber") < 3, "15.4.x-scala2.12")
        .alias("spark_version"),
        F.when(F.col("l_tax") >= 0.04, "PHOTON").otherwise("STANDARD").alias("runtime_engine"),
        F.when(F.col("l_linestatus") == "F", "RUNNING").when(F.col("l_linestatus") == "O", "TERMINATED").alias("state"),
        F.when(F.col("l_returnflag") == "A", "UI").when(F.col("l_returnflag") == "N", "API")
        .when(F.col("l_returnflag") == "R", "JOB").alias("cluster_source"),
    ]


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _inventory_base(spark, sf_dir)
    return base.select(
        *_inventory_columns(),
        F.col("l_quantity").cast("int").alias("num_workers"),
        F.lit(None).cast(S.INVENTORY["executors"].dataType).alias("executors"),
        F.lit(None).cast(S.INVENTORY["autoscale"].dataType).alias("autoscale"),
    )


def inventory_workers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inventory variant that exercises every branch of the live worker count."""
    base = _inventory_base(spark, sf_dir)
    kind = F.col("l_partkey") % 4
    executors = F.transform(
        F.sequence(F.lit(1), F.col("l_linenumber")),
        lambda i: F.struct(i.cast("string").alias("node_id")))
    return base.select(
        *_inventory_columns(),
        F.when(kind.isin(0, 1), F.col("l_quantity").cast("int")).alias("num_workers"),
        F.when(kind == 0, executors)
        .when(kind == 1, F.array().cast(S.INVENTORY["executors"].dataType)).alias("executors"),
        F.when(kind == 2, F.struct(F.col("l_linenumber").cast("int").alias("min_workers"))).alias("autoscale"),
    )


def send_log(spark: SparkSession, sf_dir: str, p: Params) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    ship = _ts("l_shipdate")
    # Sends for nine parts in ten are a decade old, outside every window; the
    # others (and all that would lie after as_of) keep the shipping date.
    years = F.when((F.col("l_partkey") % 10 != 0) | (ship > instant(p.as_of)), 10).otherwise(0)
    return li.where(F.col("l_returnflag").isin("A", "N")).select(
        F.timestamp_add("HOUR", F.col("l_linenumber") - years * 365 * 24, ship).alias("sent_at"),
        _ws("l_suppkey").alias("workspace_id"),
        F.col("l_suppkey").cast("string").alias("cluster_id"),
        F.when(F.col("l_returnflag") == "A", "WARNING").otherwise("CRITICAL").alias("signal"),
        F.lit(p.alert_channel).alias("recipient"),
        F.lit("channel_only").alias("routing"),
        F.concat_ws(".", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("message_ts"),
    )


def directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation")
    # Every third person is listed under an address that no owner has.
    name = F.when(F.col("n_nationkey") % 3 == 0, "person_").otherwise("owner_")
    return n.select(
        F.concat(name, F.col("n_nationkey").cast("string"), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("U"), F.lpad(F.col("n_nationkey").cast("string"), 8, "0")).alias("user_id"),
    )


def exclusion_rules() -> ExclusionRules:
    return TEST_RULES


# Test parameters (FIXTURES.md section 4) -------------------------------------
USAGE_PARAMS = Params(as_of=dt.datetime(2024, 1, 31), baseline_lookback_days=30)
BACKTEST_PARAMS = Params(as_of=dt.datetime(2024, 1, 31), budget_daily_dollars=100.0,
                         z_warning=2.0, z_critical=3.0, baseline_lookback_days=7,
                         backtest_lookback_days=90)
SCORING_PARAMS = Params(as_of=dt.datetime(2024, 1, 31), budget_daily_dollars=1500.0,
                        z_warning=2.0, z_critical=3.0, baseline_lookback_days=30)
ALERT_PARAMS = SCORING_PARAMS.replace(
    as_of=dt.datetime(1998, 6, 1, 12, 0), alert_recency=dt.timedelta(days=90),
    warning_suppression_hours=960, critical_suppression_hours=480,
    routing_mode="dm_with_fallback", alert_channel="#cost-alerts")

# Alerts that go silent or recover often enough to tell.
RESOLVE_PARAMS = ALERT_PARAMS.replace(alert_recency=dt.timedelta(days=10))
# The replay without the budget rule, where days can be missed.
Z_ONLY_PARAMS = BACKTEST_PARAMS.replace(use_budget_rule=False)


def glob_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rule_order, pattern: a rule table that grows with the data, one glob per customer in five shapes."""
    key = F.col("c_custkey")
    digits = F.lpad(F.pmod(key, F.lit(1000)).cast("string"), 3, "0")
    shapes = F.when(key % 5 == 0, F.concat(F.lit("*-"), key)).when(key % 5 == 1, F.concat(F.lit("?-urgent-"), key, F.lit("?"))) \
        .when(key % 5 == 2, F.concat(F.lit("[1-3]-*"), digits, F.lit("*"))).when(key % 5 == 3, F.concat(F.lit("5-[!l]*-"), key, F.lit("[")))
    return read_table(spark, sf_dir, "customer").select(
        (F.pmod(key * 7919, F.lit(1_000_003))).alias("rule_order"), shapes.otherwise(F.concat(F.lit("*gh-?"), digits)).alias("pattern"))
