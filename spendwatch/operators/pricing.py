"""Rate card, fleet aliases, customer $/DBU and the pricing_rates table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendwatch.functions.columns import instant, strip_photon_suffix
from spendwatch.operators.joins import broadcast_if_fits, join_small_side
from spendwatch.params import BROADCAST_MAX_ROWS, Params

# The rate-card rows kept (all-purpose, one plan tier).
ALL_PURPOSE_WORKLOADS = ("All-Purpose Compute", "All-Purpose Compute Photon")
KEPT_PLAN = "Premium"


def all_purpose(card: DataFrame) -> DataFrame:
    """FL8 + PR9 + PR10: keep all-purpose Premium rows, strip the Photon
    suffix from the instance name, flag Photon from the workload name."""
    kept = card.where(F.col("compute").isin(*ALL_PURPOSE_WORKLOADS) & (F.col("plan") == KEPT_PLAN))
    return kept.select(
        strip_photon_suffix(F.col("instance")).alias("node_type"),
        F.col("compute").alias("workload"),
        F.col("compute").endswith("Photon").alias("photon"),
        F.col("dburate").cast("double").alias("dbu_per_hour"),
    )


def normalise_gcp(card: DataFrame) -> DataFrame:
    """PR34 (opt-in): GCP rate cards spell some instances with '_' where the
    inventory uses '-'."""
    return card.withColumn("instance", F.regexp_replace("instance", "_", "-"))


def expand_aliases(rates: DataFrame, aliases: DataFrame) -> DataFrame:
    """JN14 + ST2: re-emit every row whose family (text before the first dot)
    equals an alias' base family under ``<alias>.<size>``, appended to the
    original rows.  The alias map is configuration (tens of rows)."""
    family = F.substring_index(F.col("node_type"), ".", 1)
    size = F.expr("substr(node_type, instr(node_type, '.') + 1)")
    alias_rows = (rates.where(F.col("node_type").contains("."))
                  .join(broadcast_if_fits(aliases, BROADCAST_MAX_ROWS), family == F.col("base_family"))
                  .withColumn("node_type", F.concat(F.col("alias"), F.lit("."), size))
                  .drop("alias", "base_family"))
    return rates.unionByName(alias_rows)


def customer_rates(priced: DataFrame) -> DataFrame:
    """AG2: one contracted rate per workspace and photon flag -- the SKU and
    $/DBU of its most recent priced usage (ties: larger sku_name, then larger
    rate).  The map-side partial aggregate leaves two rows per workspace."""
    latest = F.max_by(
        F.struct("sku_name", "dollars_per_dbu"),
        F.struct("usage_start_time", "sku_name", "dollars_per_dbu"))
    return priced.groupBy("workspace_id", "photon").agg(latest.alias("_r")).select(
        "workspace_id", "photon", F.col("_r.sku_name").alias("sku_name"),
        F.col("_r.dollars_per_dbu").cast("double").alias("dollars_per_dbu"))


def pricing_rates(card: DataFrame, cust_rates: DataFrame, aliases: DataFrame, p: Params) -> DataFrame:
    """JN13: rate card rows (with aliases) priced at each workspace's own $/DBU
    of the same photon bucket; buckets a workspace never used are skipped.  The
    smaller of rates and card is broadcast behind a size check."""
    base = all_purpose(normalise_gcp(card) if p.normalise_gcp else card)
    rows = expand_aliases(base, aliases)
    priced = join_small_side(cust_rates, rows, "photon", p.broadcast_max_rows)
    return priced.select(
        "workspace_id", F.lit(p.cloud).alias("cloud"), "node_type", "workload", "photon", "sku_name",
        "dbu_per_hour", "dollars_per_dbu",
        (F.col("dbu_per_hour") * F.col("dollars_per_dbu")).alias("dollars_per_hour"),
        instant(p.as_of).alias("refreshed_at"),
    )


def rates_with_fallback(rates: DataFrame) -> DataFrame:
    """JN9-JN11 + R5: one row per (workspace, node_type, photon) holding the
    exact rate or, when that flag has none, the opposite flag's rate.
    Duplicate (workspace, node_type, photon) rows keep the largest DBU/hr (D20)."""
    dedup = rates.groupBy("workspace_id", "node_type", "photon").agg(
        F.max(F.struct("dbu_per_hour", "dollars_per_hour")).alias("_r"))
    exact = dedup.select("workspace_id", "node_type", "photon", F.lit(0).alias("_prio"), "_r")
    opposite = dedup.select("workspace_id", "node_type", (~F.col("photon")).alias("photon"), F.lit(1).alias("_prio"), "_r")
    both = exact.unionByName(opposite)
    best = both.groupBy("workspace_id", "node_type", "photon").agg(F.min_by("_r", "_prio").alias("_r"))
    return best.select("workspace_id", "node_type", "photon",
                       F.col("_r.dbu_per_hour").alias("dbu_per_hour"),
                       F.col("_r.dollars_per_hour").alias("dollars_per_hour"))


def sku_by_photon(rates: DataFrame) -> DataFrame:
    """JN12: the bucket-level SKU per workspace and photon flag."""
    return rates.groupBy("workspace_id", "photon").agg(F.max("sku_name").alias("sku_name"))

