"""SM4: suppression as keyed state.

The state of a (workspace, cluster, signal) is the time of its last send.  An
alert is sent if that is none, or earlier than the alert by more than the tier's
window; the send becomes the state.  An event-time timer at the end of the window
clears the state, so the store holds only keys with a send inside their window and
does not grow with history, and no batch reads the send log.  The log that exists
before the first batch is the initial state.

Alerts of a key are taken in time order within a micro-batch (they are sorted by the
task, so a batch should hold polls and not years: set ``max_files`` for a backfill)
and in the order of arrival across batches.  Rows later than ``delay`` behind the
newest are dropped, as the watermark says.

``stream_alerts`` writes a batch's alerts, outbox and log rows under its epoch and
overwrites them when the batch is repeated, so a failure does not send twice.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from spendwatch import schemas as S
from spendwatch.operators import alerts as A
from spendwatch.operators.sinks import read_send_log
from spendwatch.params import Params
from spendwatch.session import workers_import
from spendwatch.streaming.common import keyed_state, write_epoch

KEYS = ["workspace_id", "cluster_id", "signal"]
AT = "decided_at"


def read_log(spark: SparkSession, log_path: str) -> DataFrame:
    return read_send_log(spark, log_path).select(*[f.name for f in S.SEND_LOG.fields])


class LastSend(StatefulProcessor):
    """Lets an alert pass unless its key's last send is within the tier's window."""

    def __init__(self, critical_hours: int, warning_hours: int, columns: list[str], ties: list[str]):
        self.windows = {"CRITICAL": critical_hours * 3_600_000_000, "WARNING": warning_hours * 3_600_000_000}
        self.columns, self.ties = columns, ties

    def init(self, handle) -> None:
        self.handle = handle
        self.sent = handle.getValueState("sent", T.StructType([T.StructField("micros", T.LongType())]))

    def _remember(self, key: tuple, micros: int) -> None:
        """Keep the send until its window has passed; one timer a key."""
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        self.sent.update((micros,))
        self.handle.registerTimer((micros + self.windows[key[2]]) // 1000 + 1)

    def handleInitialState(self, key: tuple, initialState: Row, timerValues) -> None:
        self._remember(key, initialState["micros"])

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        state = self.sent.get()
        last = state[0] if state is not None else None
        newest = last
        for row in sorted(rows, key=self._order):
            at = row["micros"]
            if newest is None or at > newest + self.windows[key[2]]:
                newest = at
                yield Row(**{c: row[c] for c in self.columns})
        if newest != last:
            self._remember(key, newest)

    def _order(self, row: Row) -> tuple:
        newest_first = -row["taken"] if row["taken"] is not None else 0
        return (row["micros"], row["taken"] is None, newest_first, *((row[c] is not None, row[c] if row[c] is not None else 0) for c in self.ties))

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.sent.clear()
        return iter(())

    def close(self) -> None:
        pass


def send_stream(alerts: DataFrame, p: Params, log: DataFrame | None = None, at: Column | None = None, delay: str = "2 hours") -> DataFrame:
    """The alerts of a stream that are sent, decided as of ``at`` (their snapshot if not given)."""
    columns = alerts.columns
    ties = [c for c in A.SCORE_TIEBREAK if c in columns and c not in KEYS]
    rows = alerts.where(F.col("signal").isin(*A.ALERT_SIGNALS)).withColumn(AT, F.col("snapshot_ts") if at is None else at)
    rows = rows.withWatermark(AT, delay).withColumn("micros", F.unix_micros(AT)).withColumn("taken", F.unix_micros("snapshot_ts"))
    workers_import(alerts.sparkSession)
    processor = LastSend(p.critical_suppression_hours, p.warning_suppression_hours, columns, ties)
    known = None
    if log is not None:
        known = A.last_send(log).select(*KEYS, F.unix_micros("last_sent_at").alias("micros")).groupBy(*KEYS)
    return rows.groupBy(*KEYS).transformWithState(processor, alerts.schema, "Append", "EventTime", known)


def stream_sends(spark: SparkSession, src: str, schema: T.StructType, out: str, p: Params, checkpoint: str, log: DataFrame | None = None,
                 max_files: int | None = None, delay: str = "2 hours") -> StreamingQuery:
    """The sends of a stream of alerts, each decided at its own snapshot, appended to ``out``."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    with keyed_state(spark):
        return (send_stream(reader.parquet(src), p, log, None, delay).writeStream.format("parquet").outputMode("append")
                .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out))


def stream_alerts(spark: SparkSession, src: str, schema, log_path: str, out: str,
                  baseline: DataFrame, directory: DataFrame, p: Params, checkpoint: str) -> StreamingQuery:
    """Routes the alerts that are sent as of ``p.as_of``: a poll of ``alerts_latest``."""
    def written(df: DataFrame, path: str, epoch_id: int) -> DataFrame:
        write_epoch(df, path, epoch_id)
        with_epoch = T.StructType([*df.schema.fields, T.StructField("epoch", T.IntegerType())])
        return spark.read.schema(with_epoch).parquet(path).where(F.col("epoch") == epoch_id).drop("epoch")

    def process(to_send: DataFrame, epoch_id: int) -> None:
        sent = written(to_send, f"{out}/alerts", epoch_id)
        outbox = written(A.alert_outbox(sent, baseline, directory, p), f"{out}/outbox", epoch_id)
        write_epoch(A.outbox_to_log(outbox), log_path, epoch_id)

    stream = spark.readStream.schema(schema).parquet(src)
    to_send = send_stream(stream, p, read_log(spark, log_path), F.lit(p.as_of).cast("timestamp"))
    with keyed_state(spark):
        return (to_send.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
                .trigger(availableNow=True).start())
