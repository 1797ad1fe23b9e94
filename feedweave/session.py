"""Session defaults, shared scratch space and size checks."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own_scratch: dict[str, str] = {}

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "feedweave", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Generated methods beyond this size are not compiled by the JVM's JIT.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = context.applicationId
    if app not in _own_scratch:
        _own_scratch[app] = tempfile.mkdtemp(prefix="feedweave-")
    return _own_scratch[app]


def fresh_dir(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """What is planned and run in here gives up its shuffle files when it ends; else they lie until the driver collects its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def stage(df: DataFrame, label: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where one result feeds several jobs: the lineage is cut, a lost executor
    only costs a re-read, and later plans see the real size of the data.
    """
    spark = df.sparkSession
    path = f"{folder}/{label}" if folder else fresh_dir(spark, label)
    with shuffles_released(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _located(spark: SparkSession, path: str):
    """The file system of a path, whatever storage it names, and the path in it."""
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def entries(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    system, location = _located(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(location)) if system.exists(location) else []


def drop_folder(spark: SparkSession, path: str) -> None:
    system, location = _located(spark, path)
    system.delete(location, True)


@contextmanager
def scratch(spark: SparkSession, label: str) -> Iterator[str]:
    """A folder in the shared space that is deleted with all staged data at the end."""
    path = fresh_dir(spark, label)
    try:
        yield path
    finally:
        drop_folder(spark, path)
