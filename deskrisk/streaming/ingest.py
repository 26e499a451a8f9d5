"""Incremental file ingestion: each landing file is loaded exactly once, by its own header.

The stream is one of file names; a checkpoint remembers which it has handed out. A batch reads its
files by their headers, unites them by name and writes ``<table>/_batch=<id>``, rows that fit below
``_kept=true`` and all others, with their text, below ``_kept=false``. Then it writes the batch's
commit, with the columns the table has from then on. A batch that is repeated after a failure has
the same id and replaces what it left; readers take only batches that are committed.

Columns are never dropped: a file without one has NULL there, and so have older batches without a
newer one. A file whose header cannot be read is a reject as a whole, as is, where no new columns
are admitted, one with other columns than declared. Neither stops the files after it.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from deskrisk.operators.files import Files
from deskrisk.operators.scratch import open_files
from deskrisk.sources.landing import DATED_GLOB, LINE, file_headers, header_columns, header_problem, read_by_header

# The file source skips files older than this before the newest one it has seen.
NO_FILE_IS_TOO_OLD = "36500d"
# Files of one batch: bounds the names and header lines that reach the driver at once.
MOST_FILES = 1000
COMMITS = "_commits"
_NAMES = "path string, modificationTime timestamp, length long, content binary"


@dataclass(frozen=True)
class Loaded:
    """What one run added."""

    rows: int
    rejects: int


class FeedError(ValueError):
    """A table is fed from two checkpoints, whose batches would replace each other."""


def _commit(files: Files, table: str, name: str) -> dict | None:
    try:
        return json.loads(files.read(f"{table}/{COMMITS}/{name}"))
    except ValueError:  # cut short; its batch will be repeated
        return None


def _last_commit(files: Files, table: str) -> dict | None:
    for name in reversed(files.names(f"{table}/{COMMITS}")):
        if name.isdigit() and (found := _commit(files, table, name)):
            return found
    return None


def is_ingested(spark: SparkSession, table_path: str) -> bool:
    return bool(Files(spark).names(f"{table_path.rstrip('/')}/{COMMITS}"))


def _read(spark: SparkSession, table_path: str, kept: bool) -> tuple[DataFrame, StructType]:
    table = table_path.rstrip("/")
    last = _last_commit(Files(spark), table)
    if last is None:
        raise FileNotFoundError(f"{table_path}: nothing was ingested here")
    columns = StructType.fromJson(last["columns"])
    stored = StructType([*columns, *[StructField(n, t) for n, t in ((LINE, StringType()), ("_batch", LongType()), ("_kept", BooleanType()))]])
    rows = spark.read.schema(stored).parquet(table)
    return rows.where((F.col("_batch") <= last["batch"]) & (F.col("_kept") == kept)), columns


def read_ingested(spark: SparkSession, table_path: str, after: int | None = None) -> DataFrame:
    """The rows that fit, with all columns any batch brought; of batches beyond ``after`` alone, if given."""
    rows, columns = _read(spark, table_path, kept=True)
    return (rows if after is None else rows.where(F.col("_batch") > after)).select(*[f"`{c}`" for c in columns.names])


def last_batch(spark: SparkSession, table_path: str) -> int | None:
    """The newest committed batch."""
    last = _last_commit(Files(spark), table_path.rstrip("/"))
    return None if last is None else last["batch"]


def read_rejects(spark: SparkSession, table_path: str) -> DataFrame:
    """``batch``, ``file`` and ``text`` of every row, or header of a file, that was not loaded."""
    rows, _ = _read(spark, table_path, kept=False)
    return rows.select(F.col("_batch").alias("batch"), F.col("_source_file").alias("file"), F.col(LINE).alias("text"))


def _load(spark: SparkSession, schema: StructType, paths: list[str], new_columns: bool) -> DataFrame:
    """Rows of these files, with ``_line`` where they are rejects."""
    headers = file_headers(spark, paths)
    bad = {h: files for h, files in headers.items() if header_problem(header_columns(h), schema, new_columns)}
    rows = read_by_header(spark, schema, {h: files for h, files in headers.items() if h not in bad})
    if not bad:
        return rows
    whole = [(file, header) for header, files in bad.items() for file in files]
    rejects = spark.createDataFrame(whole, f"_source_file string, {LINE} string").withColumn("_ingested_at", F.current_timestamp())
    return rows.unionByName(rejects, allowMissingColumns=True)


def _ingest(
    spark: SparkSession, folder: str, schema: StructType, table_path: str, checkpoint: str, pattern: str, max_files: int, new_columns: bool
) -> Loaded:
    table, files = table_path.rstrip("/"), Files(spark)
    before = _last_commit(files, table)
    if before is not None and before["checkpoint"] != checkpoint:
        raise FeedError(f"{table} is fed from {before['checkpoint']}")

    def load(names: DataFrame, batch: int) -> None:
        session = names.sparkSession
        rows = _load(session, schema, [r.path for r in names.collect()], new_columns)
        last = _last_commit(files, table)
        known = StructType.fromJson(last["columns"]) if last else StructType()
        have = {f.name.lower(): f.name for f in known}
        # A column comes under one name, however its files spell it.
        rows = rows.select(*[F.col(f"`{c}`").alias(have.get(c.lower(), c)) for c in rows.columns])
        grown = StructType([*known, *[f for f in rows.schema if f.name.lower() not in have and f.name != LINE]])
        seen = Observation()
        observed = rows.observe(
            seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col(LINE).isNotNull()).alias("rejects")
        )
        with open_files(session, 2):  # one of rows that fit, one of rejects
            (
                observed.withColumn("_kept", F.col(LINE).isNull())
                .write.mode("overwrite").partitionBy("_kept").parquet(f"{table}/_batch={batch}")
            )
        counts = {"rows": seen.get["rows"] - seen.get["rejects"], "rejects": seen.get["rejects"]}
        record = {"batch": batch, "checkpoint": checkpoint, "columns": grown.jsonValue(), **counts}
        files.write(f"{table}/{COMMITS}/{batch:012d}", json.dumps(record), replace=True)

    names = (
        spark.readStream.format("binaryFile").schema(_NAMES)  # names only: what is not selected is not read
        .option("maxFileAge", NO_FILE_IS_TOO_OLD).option("maxFilesPerTrigger", max_files)
        .load(f"{folder.rstrip('/')}/{pattern}").select("path")
    )
    query = names.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    low = -1 if before is None else before["batch"]
    new = [_commit(files, table, n) for n in files.names(f"{table}/{COMMITS}") if n.isdigit() and int(n) > low]
    return Loaded(sum(c["rows"] for c in new), sum(c["rejects"] for c in new))


def ingest_incremental(
    spark: SparkSession, folder: str, schema: StructType, table_path: str, checkpoint: str,
    pattern: str = DATED_GLOB, max_files: int = MOST_FILES,
) -> Loaded:
    """Load the files not loaded before, which must have the columns of ``schema``, in any order.

    ``max_files`` bounds one batch, so that a large backlog is worked off in pieces that fit the
    cluster. Files are loaded whatever their age, so that a backfill copied with its old times is
    not passed over. A table has one checkpoint, and is fed by it alone.
    """
    return _ingest(spark, folder, schema, table_path, checkpoint, pattern, max_files, new_columns=False)


def ingest_evolving(
    spark: SparkSession, folder: str, schema: StructType, table_path: str, checkpoint: str,
    pattern: str = DATED_GLOB, max_files: int = MOST_FILES,
) -> Loaded:
    """As ``ingest_incremental``, for files that may lack columns or bring new ones.

    A new column is text, and part of the table from its batch on; ``evolve_append`` is the same
    for rows that are a DataFrame already.
    """
    return _ingest(spark, folder, schema, table_path, checkpoint, pattern, max_files, new_columns=True)
