"""The streaming operators over the fixture, each fed in two arrivals of
several files with a restart in between."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendwatch.operators.alerts import ALERT_SIGNALS
from spendwatch.operators.joins import planned_bytes
from spendwatch.operators.sinks import read_or_empty
from spendwatch.params import Params
from spendwatch.schemas import ALERT_COLUMNS, CLUSTER_SCORES
from spendwatch.streaming import hourly, resolve, scores, suppression
from spendwatch.streaming.common import run_available_now, stream_dirs, write_epoch

FILES, FILE_BYTES = 5, 32 << 20  # per arrival at least, and about the most in a file


def _arrive(part: DataFrame, path: str) -> None:
    """``part`` reads a table, whose size the optimizer knows; its files grow in number and not in size."""
    part.repartition(max(FILES, 1 + planned_bytes(part) // FILE_BYTES)).write.mode("append").parquet(path)


def hourly_from_usage(inputs, p: Params) -> DataFrame:
    """Usage in two arrivals, in event-time order; the closed hours that the stream emitted."""
    spark = inputs.spark
    src, out, ckpt = stream_dirs(spark, "stream-hourly")
    excluded = inputs.excluded_keys(p)
    split = F.lit("2024-01-16").cast("date")
    for part in (F.col("usage_date") < split, F.col("usage_date") >= split):
        _arrive(inputs.usage.where(part), src)
        run_available_now(hourly.stream_hourly(spark, src, inputs.prices, excluded, p, out, ckpt))
    return spark.read.parquet(out)


def scores_from_inventory(inputs, p: Params) -> DataFrame:
    """The inventory in two arrivals; everything that the stream wrote.

    The fixture spreads snapshots over ~2,500 dates (a real poll holds one),
    so this check writes unpartitioned; the date-partitioned layout and its
    pruning are covered by ``sink_partitioned_scores`` and the plan tests."""
    spark = inputs.spark
    src, out, ckpt = stream_dirs(spark, "stream-scores")
    rates, base = inputs.rates_table(p), inputs.baseline_table(p)
    inventory = inputs.table("inventory-once", inputs.inventory)
    half = F.pmod(F.xxhash64("cluster_id", "snapshot_ts"), F.lit(2))
    for k in range(2):
        _arrive(inventory.where(half == k), src)
        run_available_now(scores.stream_scores(spark, src, rates, base, inputs.rules, p, out, ckpt, partition_by_date=False))
    return scores.read_stream_scores(spark, out)


def suppression_from_alerts(inputs, p: Params) -> DataFrame:
    """The alerts in two arrivals, dealt by cluster; the send log starts as
    the fixture log.  Returns the alerts that were sent."""
    spark = inputs.spark
    src, out, ckpt = stream_dirs(spark, "stream-alerts")
    log_path = f"{out}/send_log"
    write_epoch(inputs.send_log(p), log_path, -1)
    alerts = inputs.table("alerts-once", inputs.alerts(p))
    baseline = inputs.table("baseline-once", inputs.baseline())
    half = F.pmod(F.xxhash64("workspace_id", "cluster_id"), F.lit(2))
    for k in range(2):
        _arrive(alerts.where(half == k), src)
        run_available_now(suppression.stream_alerts(spark, src, alerts.schema, log_path, out, baseline, inputs.directory, p, ckpt))
    return read_or_empty(spark, f"{out}/alerts", alerts.schema).select(alerts.columns)


def sends_from_history(inputs, p: Params) -> DataFrame:
    """All alerts of the history in three arrivals, by time, each a run of its own."""
    spark = inputs.spark
    src, out, ckpt = stream_dirs(spark, "stream-sends")
    alerts = inputs.table("alerts-once", inputs.scores().where(F.col("signal").isin(*ALERT_SIGNALS)).select(*ALERT_COLUMNS))
    cuts = ["1900-01-01", "1997-03-01", "1999-07-01", "2200-01-01"]
    for lo, hi in zip(cuts, cuts[1:]):
        _arrive(alerts.where((F.col("snapshot_ts") >= lo) & (F.col("snapshot_ts") < hi)), src)
        run_available_now(suppression.stream_sends(spark, src, alerts.schema, out, p, ckpt))
    return read_or_empty(spark, out, alerts.schema)


def hourly_with_corrections(inputs, p: Params) -> DataFrame:
    """Usage in two arrivals, the second with a twentieth of the first one's days, now
    late: what the stream emitted, corrected from the ledger."""
    spark = inputs.spark
    src, out, ckpt = stream_dirs(spark, "stream-hourly-complete")
    excluded = inputs.excluded_keys(p)
    early = F.col("usage_date") < F.lit("2024-01-16").cast("date")
    late = F.pmod(F.xxhash64("usage_metadata.cluster_id", "usage_start_time"), F.lit(20)) == 0
    for part in (early & ~late, ~early | late):
        _arrive(inputs.usage.where(part), src)
        run_available_now(hourly.stream_hourly(spark, src, inputs.prices, excluded, p, out, ckpt))
        run_available_now(hourly.stream_ledger(spark, src, inputs.prices, excluded, p, f"{out}-ledger", f"{ckpt}-ledger"))
    emitted = spark.read.parquet(out)
    return hourly.corrected(emitted, hourly.corrections(spark.read.parquet(f"{out}-ledger"), emitted))


def resolved_from_scores(inputs, p: Params) -> DataFrame:
    """All scored snapshots in three arrivals, by time, each a run of its own; the ends of their alerts."""
    spark = inputs.spark
    src, out, ckpt = stream_dirs(spark, "stream-resolved")
    rows = inputs.table("scores-once", inputs.scores().select(*[c.name for c in CLUSTER_SCORES.fields]))
    cuts = ["1900-01-01", "1997-03-01", "1999-07-01", "2200-01-01"]
    for lo, hi in zip(cuts, cuts[1:]):
        _arrive(rows.where((F.col("snapshot_ts") >= lo) & (F.col("snapshot_ts") < hi)), src)
        run_available_now(resolve.stream_resolved(spark, src, rows.schema, out, p, ckpt))
    return spark.read.parquet(out)
