"""Cutting lineage: a written intermediate table on shared storage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Folders written by the run this thread works for, if it is inside ``scratch_of_run``.
_OF_RUN: ContextVar[list[str] | None] = ContextVar("settled", default=None)

_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Jobs submitted side by side; Spark shares the executors among them.
PARALLEL = 4


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset, it lies in the
    warehouse, which all executors share as well.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return a DataFrame that reads it back.

    For a result used by several branches of one plan: the branches then read only
    the columns they need from a columnar file instead of each recomputing the
    lineage, and an executor lost later does not reach back past this point.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/deskrisk-{name}-{uuid.uuid4().hex}"
    written = _OF_RUN.get()
    if written is not None:
        written.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_rows(df: DataFrame, folder: str, **measures: Column) -> dict:
    """Write ``df`` and return ``rows`` and the measures, taken from the rows as they are written."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *[m.alias(n) for n, m in measures.items()]).write.parquet(folder)
    return seen.get


@contextmanager
def open_files(spark: SparkSession, most: int) -> Iterator[None]:
    """Writes inside keep up to ``most`` files a task open instead of sorting their rows by partition."""
    before = spark.conf.get(_OPEN_FILES, "0")
    spark.conf.set(_OPEN_FILES, str(most))
    try:
        yield
    finally:
        spark.conf.set(_OPEN_FILES, before)


@contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """Let Spark delete shuffle files when the query that wrote them has ended."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder on whatever file system its path names."""
    location = spark._jvm.org.apache.hadoop.fs.Path(folder)
    location.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(location, True)


@contextmanager
def scratch_of_run(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end, every table that was settled inside, and none that another run has settled.

    Results that read such tables must be written or collected before the end. Outside of it,
    settled tables stay.
    """
    written: list[str] = []
    token = _OF_RUN.set(written)
    try:
        yield
    finally:
        _OF_RUN.reset(token)
        for folder in written:
            drop_folder(spark, folder)


def together(jobs: dict[str, Callable]) -> dict:
    """Run independent jobs side by side and return their results by name.

    Most jobs here end in a few small tasks; alone, each would leave the cluster idle.
    The first failure is raised once all have ended.
    """
    with ThreadPoolExecutor(PARALLEL) as pool:
        started = {name: pool.submit(copy_context().run, job) for name, job in jobs.items()}
    return {name: job.result() for name, job in started.items()}
