"""JN17/AG13 over history: which alerts would have been sent.

A send silences its (workspace, cluster, signal) through its tier's window, so
sends are a greedy choice of intervals: the first alert of a key is sent, and
after a send the first alert later than the send plus the window.  That makes a
chain per key.  It is followed for all keys at once by pointer jumping: every
alert points to the alert that would follow it as a send, and each round joins the
pointers with themselves, so a chain of n sends takes log2(n) rounds.

No group holds a key's alerts.  The pointers come from groups of a key and one
window length of time: the successor of an alert at ``t`` lies after ``t`` plus
the window, in the next such bucket or, if that has none, at the head of the
next bucket with an alert.  A key has at most as many buckets as the history has
window lengths, however many alerts fall into them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendwatch.operators.alerts import ALERT_SIGNALS
from spendwatch.params import Params
from spendwatch.session import remove_path, scratch_path

KEYS = ["workspace_id", "cluster_id", "signal"]


def window_micros(p: Params) -> Column:
    hour = 3600 * 1_000_000
    return F.when(F.col("signal") == "CRITICAL", F.lit(p.critical_suppression_hours * hour)).otherwise(
        F.lit(p.warning_suppression_hours * hour)).cast("long")


def alert_times(scores: DataFrame) -> DataFrame:
    """One row per key and time with an alert: ``at`` in microseconds."""
    alerts = scores.where(F.col("signal").isin(*ALERT_SIGNALS))
    return alerts.select(*KEYS, F.unix_micros("snapshot_ts").alias("at")).distinct()


def successors(times: DataFrame, p: Params) -> DataFrame:
    """KEYS, at, next: the first alert of the key later than ``at`` plus its window (null: none)."""
    rows = times.withColumn("span", window_micros(p)).withColumn("bucket", F.expr("(at - pmod(at, span)) div span"))
    alerts = rows.select(*KEYS, "bucket", F.col("at").alias("edge"), F.lit(None).cast("long").alias("asks"))
    probes = rows.select(*KEYS, (F.col("bucket") + 1).alias("bucket"), (F.col("at") + F.col("span")).alias("edge"), F.col("at").alias("asks"))
    # Within a bucket, from its end: the smallest alert beyond the probe; a probe comes before an alert of its own time.
    later = (Window.partitionBy(*KEYS, "bucket").orderBy(F.desc("edge"), F.desc_nulls_last("asks"))
             .rowsBetween(Window.unboundedPreceding, -1))
    is_alert = F.col("asks").isNull()
    near = alerts.unionByName(probes).withColumn("next", F.min(F.when(is_alert, F.col("edge"))).over(later))
    heads = near.groupBy(*KEYS, "bucket").agg(F.min(F.when(is_alert, F.col("edge"))).alias("head"))
    beyond = Window.partitionBy(*KEYS).orderBy("bucket").rowsBetween(1, Window.unboundedFollowing)
    heads = heads.select(*KEYS, "bucket", F.min("head").over(beyond).alias("far"))
    asked = near.where(~is_alert).join(heads, [*KEYS, "bucket"])
    return asked.select(*KEYS, F.col("asks").alias("at"), F.coalesce("next", "far").alias("next"))


def sends_over_history(scores: DataFrame, p: Params) -> DataFrame:
    """KEYS, sent_at: the sends that the suppression rule lets through, alert by alert, over all of ``scores``."""
    spark = scores.sparkSession

    def written(df: DataFrame) -> tuple[DataFrame, str]:
        path = scratch_path(spark, "replay")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path), path

    times, base = written(alert_times(scores))
    pointers, old = written(successors(times, p).where(F.col("next").isNotNull()))
    sends, marked = written(times.groupBy(*KEYS).agg(F.min("at").alias("at")))
    while not pointers.isEmpty():
        # Sends so far are the first 2^i of each chain, pointers lead 2^i on.
        reached = sends.join(pointers, [*KEYS, "at"]).select(*KEYS, F.col("next").alias("at"))
        more, new_marked = written(sends.unionByName(reached))
        onward = pointers.select(*KEYS, F.col("at").alias("next"), F.col("next").alias("after"))
        further, new = written(pointers.join(onward, [*KEYS, "next"]).select(*KEYS, "at", F.col("after").alias("next")))
        for path in (old, marked):
            remove_path(spark, path)
        sends, marked, pointers, old = more, new_marked, further, new
    for path in (base, old):
        remove_path(spark, path)
    return sends.select(*KEYS, F.timestamp_micros("at").alias("sent_at"))
