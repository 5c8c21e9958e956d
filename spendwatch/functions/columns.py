"""Scalar column expressions used across the stages."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Timestamp standing in for an open-ended price interval (fixed value).
OPEN_END = "9999-01-01 00:00:00"


def photon_flag(sku: Column) -> Column:
    """PR2: a usage SKU is Photon when its name contains PHOTON (any case)."""
    return F.coalesce(sku.ilike("%PHOTON%"), F.lit(False))


def worker_count() -> Column:
    """PR13: live workers = non-empty executors, else num_workers, else the
    autoscale minimum, else 0."""
    n_exec = F.size(F.col("executors"))
    return (F.when(F.col("executors").isNotNull() & (n_exec > 0), n_exec)
            .otherwise(F.coalesce(F.col("num_workers"), F.col("autoscale.min_workers"), F.lit(0)))
            .cast("int"))


def is_photon() -> Column:
    """PR14: engine PHOTON, or 'photon' inside the runtime version string."""
    return (F.coalesce(F.col("runtime_engine") == "PHOTON", F.lit(False))
            | F.coalesce(F.lower(F.col("spark_version")).contains("photon"), F.lit(False)))


def driver_type() -> Column:
    """PR15: the driver node type, falling back to the worker type when the
    driver type is NULL or empty."""
    return F.coalesce(F.nullif(F.col("driver_node_type_id"), F.lit("")), F.col("node_type_id"))


def log_z(x: Column, mu: Column, sd: Column) -> Column:
    """PR18: log-space z-score; NULL unless sd > 0 and x > 0 (guarded inside
    ``when`` so ANSI mode never evaluates ln(0) or a division by zero)."""
    return F.when((sd > 0) & (x > 0), (F.ln(x) - mu) / sd)


def strip_photon_suffix(instance: Column) -> Column:
    """PR9: drop a trailing ' (Photon)' from a rate-card instance name."""
    return F.regexp_replace(instance, r"\s*\(Photon\)\s*$", "")


def fmt_grouped(x: Column, decimals: int) -> Column:
    """Python ``{:,.Nf}``: grouped thousands, half-even on the exact value."""
    return F.format_number(x, decimals)


def fmt_plain(x: Column, decimals: int) -> Column:
    """Python ``{:.Nf}`` (no grouping)."""
    return F.regexp_replace(F.format_number(x, decimals), ",", "")


def py_bool(c: Column) -> Column:
    """Render a boolean the way Python's ``str`` does."""
    return F.when(c.isNull(), "None").when(c, "True").otherwise("False")


def py_str(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("None"))


def instant(t: dt.datetime) -> Column:
    """A point in time as a literal, whatever the time zone of the driver or
    the session; a datetime without a zone is UTC."""
    aware = t if t.tzinfo else t.replace(tzinfo=dt.timezone.utc)
    micros = (aware - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)
    return F.timestamp_micros(F.lit(micros))


def money(quantity: Column, price: Column) -> Column:
    """PR3: quantity x price with nine decimals each; wide input types (say
    DECIMAL(38,18)) would otherwise push the product's scale down to six."""
    return quantity.cast("decimal(20,9)") * price.cast("decimal(17,9)")
