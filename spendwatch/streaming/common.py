from __future__ import annotations

import contextlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spendwatch.session import scratch_path


def run_available_now(query: StreamingQuery) -> None:
    """Block until an ``availableNow`` query has drained its input."""
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def stream_dirs(spark, name: str) -> tuple[str, str, str]:
    base = scratch_path(spark, name)
    return f"{base}/in", f"{base}/out", f"{base}/checkpoint"


@contextlib.contextmanager
def keyed_state(spark):
    """Queries started inside keep their state in RocksDB, which keyed state with timers needs."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def write_epoch(df: DataFrame, path: str, epoch_id: int) -> None:
    """A batch's rows under its own epoch; a repeated batch replaces them."""
    (df.withColumn("epoch", F.lit(epoch_id)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(path))
