"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the plans are written for.  Nothing here names a
# broadcast: which side is small is decided by Spark from its measured size.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # One account may own a third of a fact table: let AQE split its shuffle
    # partition even when the split costs the next operator one more exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Attribution works per batch and leaf, so its batches should be long.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    # Monthly rows are wide (32 measures); keep them inside generated code.
    "spark.sql.codegen.maxFields": "200",
}


# Settings that only a new session can take.  Recording the Python call site of
# every column costs more than building the plans of a batch job.
START_SETTINGS = {
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def builder(app: str) -> SparkSession.Builder:
    """Session builder with all settings of this module."""
    out = SparkSession.builder.appName(app)
    for key, value in {**SQL_SETTINGS, **START_SETTINGS}.items():
        out = out.config(key, value)
    return out


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to a session the caller owns."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


# Application -> folder of sessions on one machine that name none; application -> folder of the running job.
_LOCAL_ROOTS: dict[str, str] = {}
_JOB_ROOTS: dict[str, str] = {}


def work_root(spark: SparkSession) -> str:
    """The shared folder for intermediate results.

    It is the one that ``spark.checkpoint.dir`` names.  Only a session whose tasks run in the driver's own
    process may do without; on a cluster a missing setting is an error, because a folder of the driver's
    machine would be another folder on every executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="tidewatch-")
    return _LOCAL_ROOTS[app]


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the work root, or below that of the running job."""
    root = _JOB_ROOTS.get(spark.sparkContext.applicationId) or work_root(spark)
    return f"{root}/{label}-{uuid.uuid4().hex}"


@contextmanager
def job_folder(spark: SparkSession, label: str) -> Iterator[str]:
    """What is staged inside is removed at the end, so the job's results must be written by then."""
    app, path = spark.sparkContext.applicationId, work_dir(spark, label)
    outer, _JOB_ROOTS[app] = _JOB_ROOTS.get(app), path
    try:
        yield path
    finally:
        if outer:
            _JOB_ROOTS[app] = outer
        else:
            del _JOB_ROOTS[app]
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_once(df: DataFrame, path: str) -> DataFrame:
    """Write a frame as Parquet and read it back.

    The shuffle files of the writing query are removed at its end: what it was written from is on shared storage already,
    and until the driver's memory is collected they would take executors' disks.
    """
    spark = df.sparkSession
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.parquet(path)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Materialise a frame as a table in the shared folder and read it back.

    Cuts the lineage before a step that runs many jobs on the same rows.  The
    files are on shared storage, so a lost executor costs only its own tasks.
    """
    return write_once(df, work_dir(df.sparkSession, label))
