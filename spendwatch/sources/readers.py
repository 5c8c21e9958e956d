"""Readers for the inputs: parquet tables and the JSON rate card."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The rate card is read with a fixed schema; ``dburate`` may be a JSON string
# or number, so it is read as text and cast.
_RATE_CARD_JSON = T.StructType([
    T.StructField("instance", T.StringType()),
    T.StructField("compute", T.StringType()),
    T.StructField("plan", T.StringType()),
    T.StructField("dburate", T.StringType()),
])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def rate_card_scan(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """SC5: the published rate card is one JSON array per file (``multi_line``);
    JSON Lines is read with ``multi_line=False``."""
    reader = spark.read.schema(_RATE_CARD_JSON)
    if multi_line:
        # A file is one line that ends with a character that JSON cannot hold.  The multi-line
        # reader fetches each number that is read as text again from the file, a buffer of
        # some kilobytes for every row.
        reader = reader.option("lineSep", "\0")
    raw = reader.json(path)
    return raw.select("instance", "compute", "plan", F.col("dburate").cast("double").alias("dburate"))


def write_json_lines(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").json(path)
    return path


def write_json_arrays(df: DataFrame, path: str, rows_per_file: int = 50_000) -> str:
    """The rows as files of one JSON array each, the published form of the rate card.

    A task writes the rows it holds, an array for every ``rows_per_file`` of them: nothing
    is shuffled, and neither a file nor what a task holds grows with the table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held, written = TaskContext.get().partitionId(), [], 0

        def array() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([f"{task}-{written}"]), pa.array(["[" + ",".join(held) + "]"])], names=["part", "value"])

        for batch in batches:
            for row in batch.column(0).to_pylist():
                held.append(row)
                if len(held) == rows_per_file:
                    yield array()
                    held, written = [], written + 1
        if held:
            yield array()

    rows = df.select(F.to_json(F.struct(*df.columns)).alias("row"))
    rows.mapInArrow(run, "part string, value string").write.mode("overwrite").partitionBy("part").text(path)
    return path
