"""SM2: hourly spend per cluster from a usage stream.

``stream_hourly`` emits each hour once, when the watermark closes it, and cannot
take rows that come later.  ``stream_ledger`` reads the same files and keeps every
batch's own sums by cluster-hour, under its epoch, so a repeated batch replaces its
rows; sums of sums are exact.  The ledger's totals hold late rows and open hours, and
``corrections`` are those hours that the stream has not emitted as they are.  Stream
plus corrections are the batch result at any moment, and no usage is read twice for it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spendwatch import schemas as S
from spendwatch.functions.columns import money
from spendwatch.operators.joins import price_join
from spendwatch.operators.usage import drop_excluded, hourly_spend, usage_scan, window_bounds
from spendwatch.params import Params
from spendwatch.streaming.common import write_epoch

HOUR_KEYS = ["workspace_id", "usage_date", "hour_ts", "hour_of_day", "cluster_id"]


def hourly_stream(usage_stream: DataFrame, prices: DataFrame, excluded: DataFrame, p: Params,
                  watermark: str = "2 hours") -> DataFrame:
    days = p.backtest_lookback_days + p.warmup_days
    rows = drop_excluded(usage_scan(usage_stream, p, days), excluded)
    lo, hi = window_bounds(p, days)
    priced = price_join(rows, prices, "left", lo - dt.timedelta(days=1), hi + dt.timedelta(days=1),
                        p.broadcast_max_rows)
    priced = priced.withColumn(
        "dollars", money(F.col("usage_quantity"), F.coalesce(F.col("dollars_per_dbu"), F.lit(0))))
    agg = (priced.withWatermark("usage_start_time", watermark)
           .groupBy(F.window("usage_start_time", "1 hour"), "workspace_id", "usage_date", "cluster_id")
           .agg(F.sum("usage_quantity").alias("dbus"), F.sum("dollars").alias("dollars")))
    return agg.select(
        "workspace_id", "usage_date", F.col("window.start").alias("hour_ts"),
        F.hour(F.col("window.start")).alias("hour_of_day"), "cluster_id", "dbus", "dollars")


def stream_hourly(spark: SparkSession, src: str, prices: DataFrame, excluded: DataFrame, p: Params,
                  out: str, checkpoint: str, watermark: str = "2 hours") -> StreamingQuery:
    """All files that have arrived are one batch: the watermark moves only
    after it, so files of one arrival cannot make each other late."""
    usage_stream = spark.readStream.schema(S.USAGE).parquet(src)
    hourly = hourly_stream(usage_stream, prices, excluded, p, watermark)
    return (hourly.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out))


def stream_ledger(spark: SparkSession, src: str, prices: DataFrame, excluded: DataFrame, p: Params,
                  out: str, checkpoint: str) -> StreamingQuery:
    def process(batch: DataFrame, epoch_id: int) -> None:
        write_epoch(hourly_spend(batch, prices, excluded, p), out, epoch_id)

    return (spark.readStream.schema(S.USAGE).parquet(src).writeStream.foreachBatch(process)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def ledger_totals(ledger: DataFrame) -> DataFrame:
    """Complete hourly spend of everything that has arrived."""
    return ledger.groupBy(*HOUR_KEYS).agg(F.sum("dbus").alias("dbus"), F.sum("dollars").alias("dollars"))


def corrections(ledger: DataFrame, emitted: DataFrame) -> DataFrame:
    """The hours that ``emitted`` lacks (still open, or all of it late) or has without late rows."""
    return ledger_totals(ledger).join(emitted.select(*HOUR_KEYS, "dbus", "dollars"), [*HOUR_KEYS, "dbus", "dollars"], "left_anti")


def corrected(emitted: DataFrame, corrections: DataFrame) -> DataFrame:
    columns = [*HOUR_KEYS, "dbus", "dollars"]
    kept = emitted.select(*columns).join(corrections.select(*HOUR_KEYS), HOUR_KEYS, "left_anti")
    return kept.select(*columns).unionByName(corrections.select(*columns))
