"""Session helpers: a sane local session for tests/bench and a shared scratch
location taken from ``spark.checkpoint.dir``."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.ui.enabled": "false",
}


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "spendwatch") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        # Whole-stage generated methods above 8000 bytecodes are otherwise
        # never JIT-compiled; on a cluster set the same in
        # spark.executor.extraJavaOptions.
        .config("spark.driver.extraJavaOptions", "-XX:-DontCompileHugeMethods")
    )
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def workers_import(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where the
    driver did (on a cluster it is installed, or sent with --py-files)."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, known) if x)


def require_utc(spark: SparkSession) -> None:
    """Hour and date functions follow the session time zone; the jobs are
    written for UTC and do not change the caller's session."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"set spark.sql.session.timeZone to UTC (it is {zone})")


def _private_dir(master: str) -> str:
    """A folder of this process, removed at its end; only for a local master,
    where all tasks run on this machine."""
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
    path = tempfile.mkdtemp(prefix="spendwatch-ckpt-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def pin_utc(spark: SparkSession) -> None:
    """Hour/date functions follow the session time zone; the pipeline is UTC."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint directory.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is.  Only when it is unset on a local master (tests) a private directory is
    created, and removed when the process ends; elsewhere this raises.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext on the client
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            configured = _private_dir(spark.conf.get("spark.master", ""))
            spark.conf.set("spark.checkpoint.dir", configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    sc.setCheckpointDir(_private_dir(sc.master))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/spendwatch-{name}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of ``path``, and the path as it takes it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote."""
    fs, place = file_system(spark, path)
    fs.delete(place, True)


def local_frame(spark: SparkSession, rows: list[tuple], schema: str | T.StructType) -> DataFrame:
    """A few rows as a local relation, whose size the optimizer knows (a list
    handed to ``createDataFrame`` is an RDD of unknown size)."""
    struct = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = list(zip(*rows)) if rows else [[] for _ in struct]
    table = pa.table([pa.array(list(c), to_arrow_type(f.dataType)) for c, f in zip(columns, struct)], names=struct.names)
    return spark.createDataFrame(table, struct)


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` computed once into a scratch table and read back: its lineage is
    cut, a lost executor re-reads it instead of recomputing the plan, readers
    prune its columns, and its size is known.  Never ``localCheckpoint``."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
