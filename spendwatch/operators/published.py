"""SK1-SK3: tables that change all at once, on plain Parquet in a shared folder.

A table's folder holds one folder of files per write (``version=<id>``) and
numbered manifests in ``_manifests``.  A manifest lists the parts that are the
table: a version each, and for a part of merged runs the runs whose rows in it no
longer count.  A write is invisible until its manifest is renamed into place, so a
reader, who takes the newest manifest once, sees whole versions only, a failed write
leaves the table as it was, and a repeated run replaces its own rows.

* ``publish`` replaces the table (SK1);
* ``append_run`` adds the rows of one run, or replaces those of an earlier attempt
  of it (SK2, SK3).  Runs sort by name in time order.  When FAN parts of one level
  have come together they are merged into one of the next, so a table of n runs has
  at most FAN parts a level and log(n) levels;
* ``current`` reads.

Versions that the newest KEEP manifests do not list are deleted, so a reader may be
KEEP - 1 writes behind.  Two writers of one number: the second finds the manifest
taken, and raises before it is visible.  A table is meant to have one writer at a
time, as the scheduled jobs are.
"""

from __future__ import annotations

import dataclasses
import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendwatch.session import file_system, remove_path

KEEP = 3
FAN = 32
RUN, VERSION = "run", "version"
_MANIFESTS = "_manifests"


@dataclasses.dataclass(frozen=True)
class Part:
    version: str
    level: int = 0
    first: str = ""  # the first and last run of the part; empty for a published table
    last: str = ""
    without: tuple[str, ...] = ()


def _numbers(spark: SparkSession, path: str) -> list[int]:
    fs, place = file_system(spark, f"{path}/{_MANIFESTS}")
    if not fs.exists(place):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(place)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _manifest(path: str, number: int) -> str:
    return f"{path}/{_MANIFESTS}/{number:012d}.json"


def _parts(spark: SparkSession, path: str, number: int) -> list[Part]:
    fs, place = file_system(spark, _manifest(path, number))
    stream = fs.open(place)
    try:
        text = bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
    return [Part(**{**p, "without": tuple(p["without"])}) for p in json.loads(text)]


def parts(spark: SparkSession, path: str) -> list[Part]:
    numbers = _numbers(spark, path)
    return _parts(spark, path, numbers[-1]) if numbers else []


def _commit(spark: SparkSession, path: str, after: int, own: list[Part]) -> None:
    """Make ``own`` the table, as the manifest that follows ``after``."""
    fs, draft = file_system(spark, f"{path}/{_MANIFESTS}/.{uuid.uuid4().hex}")
    _, final = file_system(spark, _manifest(path, after + 1))
    out = fs.create(draft)
    out.write(bytearray(json.dumps([dataclasses.asdict(p) for p in own]).encode()))
    out.close()
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise RuntimeError(f"another writer has changed {path} since version {after}")


def _clean(spark: SparkSession, path: str) -> None:
    """Delete what only manifests before the newest KEEP list, and those manifests."""
    numbers = _numbers(spark, path)
    held = {p.version for n in numbers[-KEEP:] for p in _parts(spark, path, n)}
    for number in numbers[:-KEEP]:
        for part in _parts(spark, path, number):
            if part.version not in held:
                remove_path(spark, f"{path}/{VERSION}={part.version}")
        remove_path(spark, _manifest(path, number))


def _write(df: DataFrame, path: str, partition_by: str | None) -> str:
    version = uuid.uuid4().hex
    if partition_by:
        # Rows of a partition come together; adaptive execution splits a large one over several tasks.
        df = df.hint("rebalance", partition_by)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(f"{path}/{VERSION}={version}")
    return version


def _read(spark: SparkSession, path: str, own: list[Part], schema: T.StructType) -> DataFrame:
    folders = [f"{path}/{VERSION}={p.version}" for p in own]
    needed = [T.StructField(VERSION, T.StringType())]
    if RUN not in schema.names and any(p.without for p in own):
        needed.append(T.StructField(RUN, T.StringType()))
    rows = spark.read.schema(T.StructType([*schema.fields, *needed])).option("basePath", path).parquet(*folders)
    gone: Column | None = None
    for p in own:
        if p.without:
            these = (F.col(VERSION) == p.version) & F.col(RUN).isin(*p.without)
            gone = these if gone is None else gone | these
    return (rows if gone is None else rows.where(~gone)).drop(*[f.name for f in needed])


def current(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table as the newest manifest has it; an empty frame if there is none yet (SK4)."""
    own = parts(spark, path)
    return _read(spark, path, own, schema) if own else spark.createDataFrame([], schema)


def current_runs(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """As ``current``, of a table of runs, with the column ``run``."""
    return current(spark, path, T.StructType([*schema.fields, T.StructField(RUN, T.StringType())]))


def publish(df: DataFrame, path: str) -> None:
    """SK1: replace the table, schema and all, in one step."""
    spark = df.sparkSession
    after = (_numbers(spark, path) or [0])[-1]
    _commit(spark, path, after, [Part(_write(df, path, None))])
    _clean(spark, path)


def _crowded(own: list[Part], fan: int) -> list[Part]:
    """The parts of the lowest level that has more than ``fan``."""
    for level in sorted({p.level for p in own}):
        of = [p for p in own if p.level == level]
        if len(of) > fan:
            return of
    return []


def append_run(df: DataFrame, path: str, run: str, partition_by: str | None = None, fan: int = FAN,
               reduce: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """SK2/SK3: the rows of ``run``, once however often it is repeated.  ``reduce`` is applied to the
    rows of runs that are merged, where a reader needs only some of them."""
    spark = df.sparkSession
    after = (_numbers(spark, path) or [0])[-1]
    held = _parts(spark, path, after) if after else []
    kept = []
    for p in held:
        if p.level == 0 and p.first == run:
            continue
        if p.level > 0 and p.first <= run <= p.last and run not in p.without:
            p = dataclasses.replace(p, without=(*p.without, run))
        kept.append(p)
    df = df.withColumn(RUN, F.lit(run))
    schema = df.schema
    own = [*kept, Part(_write(df, path, partition_by), 0, run, run)]
    while merged := _crowded(own, fan):
        rows = _read(spark, path, merged, schema)
        version = _write(reduce(rows) if reduce else rows, path, partition_by)
        own = [p for p in own if p not in merged] + [
            Part(version, merged[0].level + 1, min(p.first for p in merged), max(p.last for p in merged))]
    _commit(spark, path, after, own)
    _clean(spark, path)
