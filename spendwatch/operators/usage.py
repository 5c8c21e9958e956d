"""Usage scans, exclusions, priced usage and hourly spend."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendwatch.functions.columns import money, photon_flag
from spendwatch.functions.rules import INLINE_GLOBS, INLINE_LIST_MAX, ExclusionRules
from spendwatch.operators import globs
from spendwatch.operators.joins import broadcast_if_fits, broadcast_if_known_small, price_join
from spendwatch.params import BROADCAST_MAX_ROWS, Params

KEYS = ["workspace_id", "cluster_id"]


def window_bounds(p: Params, days: int) -> tuple[dt.date, dt.date]:
    """Half-open day window ``[as_of - days, as_of)``."""
    return p.as_of_date - dt.timedelta(days=days), p.as_of_date


def in_window(df: DataFrame, col: str, p: Params, days: int) -> DataFrame:
    """FL5: rows whose date column lies in ``[as_of - days, as_of)``.  Plain
    literal bounds, so the predicate reaches the parquet scan / partition
    filter."""
    lo, hi = window_bounds(p, days)
    return df.where((F.col(col) >= F.lit(lo)) & (F.col(col) < F.lit(hi)))


def usage_scan(usage: DataFrame, p: Params, days: int | None = None) -> DataFrame:
    """SC1 + FL2-FL5: classic all-purpose usage rows of the window, flattened."""
    days = p.baseline_lookback_days if days is None else days
    classic = usage.where(
        (F.col("billing_origin_product") == "ALL_PURPOSE")
        & ~F.col("sku_name").ilike("%SERVERLESS%")
        & F.col("usage_metadata.cluster_id").isNotNull())
    return in_window(classic, "usage_date", p, days).select(
        "workspace_id",
        F.col("usage_metadata.cluster_id").alias("cluster_id"),
        "usage_date", "usage_start_time", "sku_name", "usage_quantity",
    )


def active_clusters(usage: DataFrame, p: Params, days: int | None = None) -> DataFrame:
    """SC4/AG1: distinct (workspace, cluster) that billed in the window."""
    return usage_scan(usage, p, days).select(*KEYS).distinct()


def _history_matches(rules: ExclusionRules, history: DataFrame, max_rows: int) -> DataFrame:
    """Clusters of which any recorded version matches a name or creator rule.
    De-duplicated map-side before the shuffle: a cluster with very many
    versions is not a hot key."""
    hist = history.select(*KEYS, "cluster_name", "owned_by")
    if len(rules.name_patterns) > INLINE_GLOBS:
        found = globs.first_matching(history, "cluster_name", rules.patterns_frame(history.sparkSession)).select(F.col("name").alias("rule_name"))
        hist = hist.join(broadcast_if_fits(found, max_rows), F.col("cluster_name") == F.col("rule_name"), "left")
        hit = F.col("rule_name").isNotNull()
    else:
        hit = rules.name_matches(F.col("cluster_name"))
    if 0 < len(rules.creators) <= INLINE_LIST_MAX:  # a hash-set lookup inside the generated code
        hit = hit | F.coalesce(F.col("owned_by").isin(*rules.creators), F.lit(False))
    elif rules.creators:
        creators = broadcast_if_known_small(rules.creators_frame(history.sparkSession), len(rules.creators), max_rows)
        hist = hist.join(creators, F.col("owned_by") == F.col("rule_creator"), "left")
        hit = hit | F.col("rule_creator").isNotNull()
    return hist.where(hit).select(*KEYS).distinct()


def resolve_exclusions(rules: ExclusionRules, history: DataFrame, active: DataFrame,
                       max_rows: int = 2_000_000) -> DataFrame:
    """JN3 + ST1: (workspace, cluster) pairs to exclude, bounded to ``active``.

    An id rule matches the cluster id in any workspace; a name glob or creator
    rule matches when any recorded version of the cluster (same workspace)
    matched.  The rule lists are small configuration and are broadcast after a
    size check.
    """
    spark = active.sparkSession
    parts = []
    if rules.ids:
        ids = broadcast_if_known_small(rules.ids_frame(spark), len(rules.ids), max_rows)
        parts.append(active.join(ids, F.col("cluster_id") == F.col("rule_id"), "left_semi"))
    if rules.name_patterns or rules.creators:
        parts.append(active.join(_history_matches(rules, history, max_rows), KEYS, "left_semi"))
    if not parts:
        return active.limit(0)
    out = parts[0]
    for extra in parts[1:]:
        out = out.unionByName(extra)
    return out.distinct()


def exclusion_keys(rules: ExclusionRules, history: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """(workspace, cluster) keys that the rules name, straight from rules and
    history: an anti join needs no bound by the active clusters, so usage is
    not scanned for it.  An id rule has a NULL workspace: any workspace."""
    spark = history.sparkSession
    out = rules.ids_frame(spark).select(F.lit(None).cast("long").alias("workspace_id"), F.col("rule_id").alias("cluster_id"))
    if rules.name_patterns or rules.creators:
        out = out.unionByName(_history_matches(rules, history, max_rows))
    return out


def drop_excluded(usage_rows: DataFrame, excluded: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """JN4: anti join instead of a literal NOT IN list (no size limit); the
    keys are broadcast behind a size check, so usage rows stay where they are."""
    e = broadcast_if_fits(excluded.select(F.col("workspace_id").alias("_x_ws"), F.col("cluster_id").alias("_x_id")), max_rows)
    same = (F.col("cluster_id") == F.col("_x_id")) & (F.col("_x_ws").isNull() | (F.col("workspace_id") == F.col("_x_ws")))
    return usage_rows.join(e, same, "left_anti")


def priced_usage(usage: DataFrame, prices: DataFrame, excluded: DataFrame, p: Params) -> DataFrame:
    """SC8: the baseline path -- window usage, excluded clusters dropped, inner
    temporal join with the price in force; money stays DECIMAL."""
    rows = drop_excluded(usage_scan(usage, p), excluded, p.broadcast_max_rows)
    lo, hi = window_bounds(p, p.baseline_lookback_days)
    j = price_join(rows, prices, "inner", lo - dt.timedelta(days=1), hi + dt.timedelta(days=1),
                   p.broadcast_max_rows)
    return j.select(
        "workspace_id", "usage_date", "usage_start_time", "cluster_id", "sku_name",
        photon_flag(F.col("sku_name")).alias("photon"),
        F.col("usage_quantity").alias("dbus"),
        "dollars_per_dbu",
        money(F.col("usage_quantity"), F.col("dollars_per_dbu")).alias("dollars"),
    )


def priced_daily(priced: DataFrame) -> DataFrame:
    """Priced usage summed to (workspace, day, cluster, SKU, rate), with the
    latest start: all that the daily tables need of it, in the same columns and
    far fewer rows.  Money sums are exact, so the tables come out the same."""
    return priced.groupBy("workspace_id", "usage_date", "cluster_id", "sku_name", "photon", "dollars_per_dbu").agg(
        F.max("usage_start_time").alias("usage_start_time"), F.sum("dbus").alias("dbus"), F.sum("dollars").alias("dollars"))


def price_overlaps(usage: DataFrame, prices: DataFrame, p: Params) -> DataFrame:
    """D19 validation: per priced SKU, how many extra rows overlapping price
    intervals add to the window (join rows minus usage rows with a match).
    Two grouped counts with map-side partial aggregation; no row ids."""
    rows = usage_scan(usage, p)
    lo, hi = window_bounds(p, p.baseline_lookback_days)
    bounds = (lo - dt.timedelta(days=1), hi + dt.timedelta(days=1), p.broadcast_max_rows)
    fanned = price_join(rows, prices, "inner", *bounds).groupBy("sku_name").agg(
        F.count(F.lit(1)).alias("_n_join"))
    matched = price_join(rows, prices, "left_semi", *bounds).groupBy("sku_name").agg(
        F.count(F.lit(1)).alias("_n_rows"))
    return matched.join(fanned, "sku_name").select(
        "sku_name", (F.col("_n_join") - F.col("_n_rows")).alias("n_overlaps"))


def hourly_spend(usage: DataFrame, prices: DataFrame, excluded: DataFrame, p: Params,
                 days: int | None = None) -> DataFrame:
    """The backtest path: left temporal join (unpriced usage costs 0), summed
    per cluster-hour.  Partial aggregation happens before the shuffle."""
    days = p.backtest_lookback_days + p.warmup_days if days is None else days
    rows = drop_excluded(usage_scan(usage, p, days), excluded, p.broadcast_max_rows)
    lo, hi = window_bounds(p, days)
    j = price_join(rows, prices, "left", lo - dt.timedelta(days=1), hi + dt.timedelta(days=1),
                   p.broadcast_max_rows)
    priced = j.select(
        "workspace_id", "usage_date",
        F.date_trunc("hour", F.col("usage_start_time")).alias("hour_ts"),
        F.hour("usage_start_time").alias("hour_of_day"),
        "cluster_id",
        F.col("usage_quantity").alias("dbus"),
        money(F.col("usage_quantity"), F.coalesce(F.col("dollars_per_dbu"), F.lit(0))).alias("dollars"),
    )
    return priced.groupBy("workspace_id", "usage_date", "hour_ts", "hour_of_day", "cluster_id").agg(
        F.sum("dbus").alias("dbus"), F.sum("dollars").alias("dollars"))
