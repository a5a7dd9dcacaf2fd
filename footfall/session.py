"""Session settings and the shared folder used between stages of a job."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # The JVM compiles no method beyond 8000 bytes; Spark then splits or interprets it instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app: str = "footfall", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here relies on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``.

    Only a local session, where every task sees the same disk, gets a folder of its own when none
    is named; on a cluster a missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"spark.checkpoint.dir must name a folder shared by all executors (master {master})")
    own = tempfile.mkdtemp(prefix="footfall-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/footfall/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Several consumers then read the same stored rows, and a lost executor costs a re-read
    instead of a recomputation.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staging(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """``staged`` for the length of a job: its folders go when the job ends, however it ends."""
    paths: list[str] = []

    def stage(df: DataFrame, name: str) -> DataFrame:
        paths.append(shared_path(spark, name))
        df.write.parquet(paths[-1])
        return spark.read.schema(df.schema).parquet(paths[-1])

    try:
        yield stage
    finally:
        delete_paths(spark, paths)


@contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Send rows to Python tasks in batches of so many: the JVM and the worker of each task hold one at a time."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def delete_paths(spark: SparkSession, paths: list[str]) -> None:
    """Remove files or folders on whatever file system they are."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def make_folder(spark: SparkSession, path: str) -> None:
    """An empty folder on whatever file system it is, if there is none yet."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(at)


@cache
def _packed() -> str:
    """This package as a zip file, made once per driver process."""
    package = os.path.dirname(os.path.abspath(__file__))
    base = os.path.join(tempfile.mkdtemp(prefix="footfall-code-"), "footfall_code")
    return shutil.make_archive(base, "zip", os.path.dirname(package), os.path.basename(package))


def ship_package(spark: SparkSession) -> None:
    """Let the Python workers of all executors import this package (a second call changes nothing)."""
    spark.sparkContext.addPyFile(_packed())
