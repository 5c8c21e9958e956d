"""SM3: alerts that end, as a stream.

An alert of a cluster is open while its latest snapshot is WARNING or CRITICAL and
no older than ``alert_recency``.  It ends with the first snapshot of another signal
("recovered") or, without a snapshot, when the last one gets too old ("silent").
The state is the time of an open alert's last snapshot and has one event-time timer,
so a cluster that is deleted while flagged is resolved without any further row.
Clusters without an open alert hold no state.

Rows of a cluster in one micro-batch are sorted in time by the task, with only the
columns that decide; of rows with one time the first by the score order counts, as in
``alerts_latest``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from spendwatch.operators.alerts import ALERT_SIGNALS, SCORE_TIEBREAK
from spendwatch.params import Params
from spendwatch.session import workers_import
from spendwatch.streaming.common import keyed_state

KEYS = ["workspace_id", "cluster_id"]
RESOLVED = "workspace_id long, cluster_id string, resolved_micros long, why string"


class OpenAlert(StatefulProcessor):
    def __init__(self, recency: dt.timedelta, ties: list[str]):
        self.recency = int(recency.total_seconds() * 1_000_000)
        self.ties = ties

    def init(self, handle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", T.StructType([T.StructField("micros", T.LongType())]))

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        state = self.seen.get()
        before = last = state[0] if state is not None else None
        firsts = {}
        for row in rows:
            at = row["micros"]
            firsts[at] = min(firsts[at], row, key=self._order) if at in firsts else row
        for at in sorted(firsts):
            if last is not None and at > last + self.recency:
                yield self._resolved(key, last + self.recency, "silent")
                last = None
            if firsts[at]["signal"] in ALERT_SIGNALS:
                last = at
            elif last is not None:
                yield self._resolved(key, at, "recovered")
                last = None
        if last != before:
            for timer in self.handle.listTimers():
                self.handle.deleteTimer(timer)
            if last is None:
                self.seen.clear()
            else:
                self.seen.update((last,))
                self.handle.registerTimer((last + self.recency) // 1000 + 1)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        state = self.seen.get()
        if state is not None:
            self.seen.clear()
            yield self._resolved(key, state[0] + self.recency, "silent")

    @staticmethod
    def _resolved(key: tuple, micros: int, why: str) -> Row:
        return Row(workspace_id=key[0], cluster_id=key[1], resolved_micros=micros, why=why)

    def _order(self, row: Row) -> tuple:
        return tuple((row[c] is not None, row[c] if row[c] is not None else 0) for c in self.ties)

    def close(self) -> None:
        pass


def resolved_stream(scores: DataFrame, p: Params, delay: str = "2 hours") -> DataFrame:
    """workspace_id, cluster_id, resolved_at, why: the ends of alerts in a stream of scored snapshots."""
    workers_import(scores.sparkSession)
    ties = [c for c in SCORE_TIEBREAK if c in scores.columns]
    rows = (scores.select(*dict.fromkeys([*KEYS, "snapshot_ts", "signal", *ties])).withWatermark("snapshot_ts", delay)
            .withColumn("micros", F.unix_micros("snapshot_ts")))
    out = rows.groupBy(*KEYS).transformWithState(OpenAlert(p.alert_recency, ties), RESOLVED, "Append", "EventTime")
    return out.select(*KEYS, F.timestamp_micros("resolved_micros").alias("resolved_at"), "why")


def stream_resolved(spark: SparkSession, src: str, schema: T.StructType, out: str, p: Params, checkpoint: str,
                    max_files: int | None = None, delay: str = "2 hours") -> StreamingQuery:
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    with keyed_state(spark):
        return (resolved_stream(reader.parquet(src), p, delay).writeStream.format("parquet").outputMode("append")
                .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out))
