"""SM1: inventory snapshots arrive as files; each micro-batch is scored with
broadcast joins and added to ``cluster_scores`` as a run of its own.

A batch is scored as a table, so adaptive execution sizes its writers: a poll
holds one date, whose rows are split over as many files as they need.  The run
is the epoch; a batch repeated after a failure replaces its rows, and readers see
whole batches only (``operators.published``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from spendwatch import schemas as S
from spendwatch.functions.rules import ExclusionRules
from spendwatch.operators import published
from spendwatch.operators.scoring import score_inventory
from spendwatch.params import Params


def stream_scores(spark: SparkSession, src: str, rates: DataFrame, baseline: DataFrame,
                  rules: ExclusionRules, p: Params, out: str, checkpoint: str,
                  available_now: bool = True, max_files_per_trigger: int | None = None,
                  partition_by_date: bool = True) -> StreamingQuery:
    def process(batch: DataFrame, epoch_id: int) -> None:
        scored = score_inventory(batch, rates, baseline, rules, p)
        published.append_run(scored, out, f"epoch-{epoch_id:012d}", "snapshot_date" if partition_by_date else None)

    reader = spark.readStream.schema(S.INVENTORY)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    writer = reader.parquet(src).writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="15 minutes")
    return writer.start()


def read_stream_scores(spark: SparkSession, out: str) -> DataFrame:
    return published.current_runs(spark, out, S.CLUSTER_SCORES).drop(published.RUN)
