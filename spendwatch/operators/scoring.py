"""Scoring live inventory snapshots against rates, baseline, budget and rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendwatch.functions.columns import (
    driver_type, fmt_grouped, fmt_plain, is_photon, log_z, py_bool, py_str, worker_count)
from spendwatch.functions.rules import INLINE_GLOBS, INLINE_LIST_MAX, ExclusionRules
from spendwatch.operators import globs
from spendwatch.operators.baseline import attach_baseline, baseline_latest
from spendwatch.operators.joins import broadcast_if_fits, broadcast_if_known_small
from spendwatch.operators.pricing import rates_with_fallback, sku_by_photon
from spendwatch.params import Params

# What counts as a live all-purpose cluster.
LIVE_STATES = ("RUNNING", "RESIZING")
LIVE_SOURCES = ("UI", "API")


def live_inventory(inv: DataFrame) -> DataFrame:
    """SC6: running/resizing clusters created from the UI or the API."""
    return inv.where(F.col("state").isin(*LIVE_STATES) & F.col("cluster_source").isin(*LIVE_SOURCES))


def exclusion_reason(inv: DataFrame, rules: ExclusionRules, p: Params) -> DataFrame:
    """JN16: adds ``excluded_reason`` -- the first matching rule in priority
    order id, name patterns (list order), creator; NULL when none matches.

    Id and creator lists are joined (broadcast behind a size check, a left
    join per list, so list length is not limited); a few name globs become one
    folded expression, more are looked up by ``globs.first_matching`` (a stream
    keeps the expression).  The inventory is not shuffled for a side that fits.
    """
    spark = inv.sparkSession
    out = inv

    def member(values: tuple[str, ...], col: str, tag: str):
        nonlocal out
        if len(values) <= INLINE_LIST_MAX:  # a hash-set lookup inside the generated code
            return F.col(col).isin(*values)
        frame = (rules.ids_frame(spark) if tag == "rule_id" else rules.creators_frame(spark))
        out = out.join(broadcast_if_known_small(frame, len(values), p.broadcast_max_rows),
                       F.col(col) == F.col(tag), "left")
        return F.col(tag).isNotNull()

    id_reason = F.lit(None).cast("string")
    creator_reason = F.lit(None).cast("string")
    if rules.ids:
        id_reason = F.when(member(rules.ids, "cluster_id", "rule_id"),
                           F.concat(F.lit("cluster_id "), F.col("cluster_id"), F.lit(" in exclusion rules")))
    if rules.creators:
        creator_reason = F.when(member(rules.creators, "creator_user_name", "rule_creator"),
                                F.concat(F.lit("creator "), F.col("creator_user_name"), F.lit(" in exclusion rules")))
    if len(rules.name_patterns) > INLINE_GLOBS and not inv.isStreaming:
        found = globs.first_matching(inv, "cluster_name", rules.patterns_frame(spark))
        found = found.select(F.col("name").alias("rule_name"), F.col("pattern").alias("rule_pattern"))
        out = out.join(broadcast_if_fits(found, p.broadcast_max_rows), F.col("cluster_name") == F.col("rule_name"), "left")
        name_reason = F.concat(F.lit("cluster_name matches pattern '"), F.col("rule_pattern"), F.lit("'"))
    else:
        name_reason = rules.name_reason(F.col("cluster_name"))
    out = out.withColumn("excluded_reason", F.coalesce(id_reason, name_reason, creator_reason))
    return out.drop(*[c for c in ("rule_id", "rule_creator", "rule_name", "rule_pattern") if c in out.columns])


def _rate_lookup(df: DataFrame, rates: DataFrame, node_col: str, prefix: str) -> DataFrame:
    r = rates.select(F.col("workspace_id").alias(f"{prefix}_ws"), F.col("node_type").alias(f"{prefix}_node"), F.col("photon").alias(f"{prefix}_photon"),
                     F.col("dbu_per_hour").alias(f"{prefix}_dbu"), F.col("dollars_per_hour").alias(f"{prefix}_dph"))
    cond = (F.col("workspace_id") == F.col(f"{prefix}_ws")) & (F.col(node_col) == F.col(f"{prefix}_node")) & (F.col("photon") == F.col(f"{prefix}_photon"))
    return df.join(r, cond, "left").drop(f"{prefix}_ws", f"{prefix}_node", f"{prefix}_photon")


def inventory_columns(inv: DataFrame) -> DataFrame:
    """PR13-PR15: worker count, photon flag, driver/worker node types."""
    return inv.select(
        "*",
        driver_type().alias("driver_node_type"),
        F.col("node_type_id").alias("node_type"),
        worker_count().alias("workers"),
        is_photon().alias("photon"),
    )


def lookup_exact(inv: DataFrame, rates: DataFrame, p: Params) -> DataFrame:
    """JN9/JN10 without fallback: driver and worker DBU/hr for the cluster's
    own photon flag."""
    table = rates.groupBy("workspace_id", "node_type", "photon").agg(
        F.max("dbu_per_hour").alias("dbu_per_hour"), F.max("dollars_per_hour").alias("dollars_per_hour"))
    table = broadcast_if_fits(table, p.broadcast_max_rows)
    cols = inventory_columns(inv)
    return _rate_lookup(_rate_lookup(cols, table, "driver_node_type", "drv"), table, "node_type", "wkr")


def project(df: DataFrame) -> DataFrame:
    """PR16 + PR17: cluster DBU/hr and $/hr = driver + workers x worker; x 24."""
    workers = F.col("workers")
    return df.select(
        "*",
        (F.col("drv_dbu") + workers * F.col("wkr_dbu")).alias("dbu_per_hour"),
        (F.col("drv_dph") + workers * F.col("wkr_dph")).alias("dollars_per_hour"),
    ).withColumn("projected_daily_dollars", F.col("dollars_per_hour") * 24.0)


def score_reason(projected: Column, z: Column, p: Params) -> Column:
    """PR21: '; '-joined reasons, or 'within thresholds'."""
    budget_txt = f"{p.budget_daily_dollars:,.0f}"
    over_budget = F.when(projected > p.budget_daily_dollars, F.concat(
        F.lit("projected_daily $"), fmt_grouped(projected, 0), F.lit(f" > budget ${budget_txt}")))
    z_txt = F.when(z > p.z_critical, F.concat(F.lit("log-z="), fmt_plain(z, 1), F.lit(f" > critical {p.z_critical}"))) \
        .when(z > p.z_warning, F.concat(F.lit("log-z="), fmt_plain(z, 1), F.lit(f" > warning {p.z_warning}")))
    return F.when(over_budget.isNull() & z_txt.isNull(), F.lit("within thresholds")) \
        .otherwise(F.concat_ws("; ", over_budget, z_txt))


def live_tier(projected: Column, z: Column, p: Params) -> Column:
    """PR19 (scored rows): CRITICAL on budget or z, WARNING on z, else OK."""
    return (F.when((projected > p.budget_daily_dollars) | (z > p.z_critical), "CRITICAL")
            .when(z > p.z_warning, "WARNING").otherwise("OK"))


def score_inventory(inv: DataFrame, rates: DataFrame, baseline: DataFrame, rules: ExclusionRules,
                    p: Params) -> DataFrame:
    """The monitor: one scored row per live inventory snapshot.

    The right-hand sides (rates, baseline and SKU of each workspace) are
    broadcast behind size checks, so the inventory flows through one narrow
    stage with no Exchange.
    """
    if "cloud" in rates.columns:
        rates = rates.where(F.col("cloud") == p.cloud)  # FL9
    table = broadcast_if_fits(rates_with_fallback(rates), p.broadcast_max_rows)
    base = baseline_latest(baseline).select(
        "workspace_id",
        F.coalesce("mean_daily_dollars", F.lit(0.0)).alias("baseline_mean"),
        F.coalesce("stddev_daily_dollars", F.lit(0.0)).alias("baseline_stddev"),
        F.coalesce("mean_log_daily_dollars", F.lit(0.0)).alias("_mu_log"),
        F.coalesce("stddev_log_daily_dollars", F.lit(0.0)).alias("_sd_log"))
    skus = broadcast_if_fits(sku_by_photon(rates), p.broadcast_max_rows)

    df = inventory_columns(live_inventory(inv))
    df = df.join(skus, ["workspace_id", "photon"], "left")
    df = _rate_lookup(df, table, "driver_node_type", "drv")
    df = _rate_lookup(df, table, "node_type", "wkr")
    df = exclusion_reason(df, rules, p)
    df = attach_baseline(df, base, ["workspace_id"])
    df = project(df)

    missing = F.col("drv_dbu").isNull() | F.col("wkr_dbu").isNull()
    excluded = F.col("excluded_reason").isNotNull()
    scored = ~excluded & ~missing
    projected = F.col("projected_daily_dollars")
    z = log_z(projected, F.col("_mu_log"), F.col("_sd_log"))
    df = df.withColumn("_z", F.when(scored, z))
    z = F.col("_z")
    missing_txt = F.concat(F.lit("Missing pricing for driver="), py_str(F.col("driver_node_type")),
                           F.lit(" worker="), py_str(F.col("node_type")),
                           F.lit(" photon="), py_bool(F.col("photon")))
    signal = F.when(excluded, "EXCLUDED").when(missing, "UNKNOWN").otherwise(live_tier(projected, z, p))
    reason = F.when(excluded, F.col("excluded_reason")).when(missing, missing_txt) \
        .otherwise(score_reason(projected, z, p))
    return df.select(
        "workspace_id", "snapshot_ts", F.to_date("snapshot_ts").alias("snapshot_date"),
        "cluster_id", "cluster_name", F.col("creator_user_name").alias("creator"), "cluster_source",
        "node_type", "driver_node_type", F.col("workers").alias("num_workers"), "photon", "sku_name",
        F.when(scored, F.col("dbu_per_hour")).alias("dbu_per_hour"),
        F.when(scored, F.col("dollars_per_hour")).alias("dollars_per_hour"),
        F.when(scored, projected).alias("projected_daily_dollars"),
        "baseline_mean", "baseline_stddev",
        z.alias("z_score"), signal.alias("signal"), reason.alias("reason"),
    )


def signal_summary(scores: DataFrame) -> DataFrame:
    """AG12 + SO1: rows per signal."""
    return scores.groupBy("signal").agg(F.count(F.lit(1)).alias("n")).orderBy("signal")
