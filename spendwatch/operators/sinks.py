"""Table writes: overwrite, append, date-partitioned scores, empty-if-absent."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendwatch import schemas as S


def overwrite(df: DataFrame, path: str) -> None:
    """SK1: full replace of a snapshot table (schema replaced too)."""
    df.write.mode("overwrite").parquet(path)


def append(df: DataFrame, path: str) -> None:
    """SK2: append to an append-only table."""
    df.write.mode("append").parquet(path)


def write_scores(scores: DataFrame, path: str, mode: str = "append") -> None:
    """SK3: ``cluster_scores`` partitioned by the derived ``snapshot_date`` so
    date predicates prune whole directories.

    A rebalance hint brings the rows of a date together, and adaptive
    execution splits a large date into several writer tasks of the advisory
    size: a small poll is one file, a large one is not one task.
    """
    if "snapshot_date" not in scores.columns:
        scores = scores.withColumn("snapshot_date", F.to_date("snapshot_ts"))
    (scores.hint("rebalance", "snapshot_date")
     .write.mode(mode).partitionBy("snapshot_date").parquet(path))


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """SK4: a table that may not exist yet reads as an empty frame of its
    schema instead of failing."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, S.CLUSTER_SCORES)


def read_send_log(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, S.SEND_LOG)
