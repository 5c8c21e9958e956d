"""Shared helpers: test tables, staged tables in the shared folder, grouped Arrow streams."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendwatch.session import scratch_path


def workers_import(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where the
    driver did (on a cluster it is installed, or sent with --py-files)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, known) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    workers_import(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: the lineage is
    cut, several consumers share one computation, and a lost executor only
    costs the tasks it was running."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def trimmed(docs: DataFrame, *names: str) -> DataFrame:
    """Only the named columns of an input that may carry any others.  A name
    that the input has twice is refused rather than guessed."""
    for name in names:
        if docs.columns.count(name) != 1:
            raise ValueError(f"input needs exactly one column {name!r}; it has {docs.columns}")
    return docs.select(*names)


def empty_if_null(name: str):
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def grouped(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Consecutive rows with one ``key`` as a table.  The input partition must
    be sorted by the key; memory is bounded by the largest group."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        keys = batch.column(batch.schema.get_field_index(key)).to_pylist()
        start = 0
        for i in range(1, len(keys) + 1):
            if i < len(keys) and keys[i] == keys[start]:
                continue
            part = batch.slice(start, i - start)
            if held and keys[start] != current:
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
            current = keys[start]
            start = i
    if held:
        yield pa.Table.from_batches(held)
