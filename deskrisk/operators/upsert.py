"""Keyed upsert of dated history, without a table format that has MERGE."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from deskrisk.operators.checks import QualityError, refuse
from deskrisk.operators.files import Files
from deskrisk.operators.scratch import drop_folder, stage_rows

_COMMIT = "_COMMITTED"


class SchemaDriftError(ValueError):
    """A result no longer has the columns its table was declared with."""


class DuplicateKeyError(ValueError):
    """One key appears twice in the rows to merge, so the outcome would be arbitrary."""


def schema_guard(df: DataFrame, expected: StructType) -> DataFrame:
    """Return ``df`` with its columns in table order, or fail naming every difference."""
    have = {f.name: f.dataType for f in df.schema}
    want = {f.name: f.dataType for f in expected}
    problems = [f"missing {n}" for n in want if n not in have]
    problems += [f"unexpected {n}" for n in have if n not in want]
    problems += [
        f"{n} is {have[n].simpleString()}, expected {want[n].simpleString()}"
        for n in want
        if n in have and have[n] != want[n]
    ]
    if problems:
        raise SchemaDriftError("; ".join(problems))
    return df.select(*want)


def merge_frames(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] | None = None,
    newest_by: Sequence[str] = (),
) -> DataFrame:
    """The table after the upsert, as one full outer join on ``keys``.

    A key found on both sides keeps the target row but takes ``update_cols`` (all
    non-key columns when not given) from the source, NULLs included. A key only in
    the source is inserted whole; a key only in the target is left alone. With
    ``newest_by``, the target row also stays as it is where it is the newer one by these columns.
    """
    updates = set(update_cols if update_cols is not None else target.columns) - set(keys)
    unknown = (updates | set(keys)) - set(source.columns)
    if unknown:
        raise SchemaDriftError(f"merge source lacks {sorted(unknown)}")
    t = target.withColumn("_in_target", F.lit(True)).alias("t")
    s = source.select(*target.columns).withColumn("_in_source", F.lit(True)).alias("s")
    joined = t.join(s, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys], "full_outer")
    from_source = F.col("_in_source").isNotNull()
    if newest_by:
        ours, theirs = (F.struct(*[F.col(f"{side}.{c}") for c in newest_by]) for side in "st")
        from_source &= F.col("_in_target").isNull() | (ours >= theirs)
    is_new = F.col("_in_target").isNull()
    return joined.select(
        *[
            F.when(from_source if c in updates else is_new, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
            for c in target.columns
        ]
    )


def merge_into(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] | None,
    partition_col: str,
    newest_by: Sequence[str] = (),
    rules: dict[str, Column] | None = None,
) -> None:
    """Upsert ``source`` into the Parquet table at ``path``.

    ``partition_col`` is the table's date column and one of ``keys``, so only the dates in ``source``
    are read, and only they are rewritten. ``source`` is evaluated once, and the merged rows are
    written beside the table first, since a plan must not overwrite the files it reads.

    When they are all there, a commit record says so; from then on the merge will be completed. Every
    merge, of whatever dates, first completes or discards what an ended run left (``recover``), so
    that a run may end anywhere. One run at a time writes a table.

    ``newest_by`` is as in ``merge_frames``. ``rules`` (see ``write_rules``) count offending rows among
    those to be written; a count above zero raises ``QualityError`` before the table is touched.
    """
    if partition_col not in keys:
        raise ValueError(f"{partition_col} must be one of the merge keys")
    recover(spark, path)
    stage = f"{_stages(path)}/{uuid.uuid4().hex}"
    existing = read_table(spark, path, source.schema)
    # Into a new table the source goes as it is, so it is judged as it is written.
    seen = stage_rows(source, f"{stage}/source", **(rules or {} if existing is None else {}))
    rows = spark.read.schema(source.schema).parquet(f"{stage}/source")

    twice = rows.groupBy(*keys).count().where("count > 1").limit(1)
    if not twice.isEmpty():
        drop_folder(spark, stage)
        raise DuplicateKeyError(f"merge source repeats a key of {list(keys)}")
    first, last, undated = rows.agg(
        F.min(partition_col), F.max(partition_col), F.count_if(F.col(partition_col).isNull())
    ).first()
    if undated:
        drop_folder(spark, stage)
        raise ValueError(f"{undated} rows of the merge source have no {partition_col}")
    if first is None:
        drop_folder(spark, stage)
        return

    staged = "source"
    if existing is not None:
        staged = "merged"
        # The span prunes partitions as it is planned, the join the dates inside it that have no rows.
        dates = rows.select(partition_col).distinct()
        touched = existing.where(F.col(partition_col).between(first, last)).join(dates, partition_col, "left_semi")
        rows = merge_frames(touched.select(*source.columns), rows, keys, update_cols, newest_by)
        seen = stage_rows(rows, f"{stage}/merged", **(rules or {}))
    try:
        refuse(seen, path)
    except QualityError:
        drop_folder(spark, stage)
        raise
    if staged != "source":
        drop_folder(spark, f"{stage}/source")  # the merged rows hold it
    record = {"columns": rows.schema.jsonValue(), "partition": partition_col, "staged": staged}
    Files(spark).write(f"{stage}/{_COMMIT}", json.dumps(record))
    _publish(spark, path, stage, record)


def _stages(path: str) -> str:
    return f"{path.rstrip('/')}__stage"


def _publish(spark: SparkSession, path: str, stage: str, record: dict) -> None:
    """Replace the dates of the staged rows in the table; doing so again gives the same table."""
    (
        spark.read.schema(StructType.fromJson(record["columns"]))
        .parquet(f"{stage}/{record.get('staged', 'merged')}")
        .hint("rebalance", record["partition"])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(record["partition"])
        .parquet(path)
    )
    Files(spark).delete(f"{stage}/{_COMMIT}")  # first, so that a stage half removed is not published again
    drop_folder(spark, stage)


def recover(spark: SparkSession, path: str) -> int:
    """Finish what ended merges left beside the table; returns how many were completed.

    A stage with a commit record holds all merged rows and is published. One without is discarded:
    the table was not touched yet.
    """
    files, completed = Files(spark), 0
    for name in files.names(_stages(path)):
        stage = f"{_stages(path)}/{name}"
        record = None
        if files.exists(f"{stage}/{_COMMIT}"):
            try:
                record = json.loads(files.read(f"{stage}/{_COMMIT}"))
            except ValueError:  # the record itself was cut short
                record = None
        if record is None:
            drop_folder(spark, stage)
        else:
            _publish(spark, path, stage, record)
            completed += 1
    return completed


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    """The table at ``path``, or None when it was never written."""
    if not Files(spark).exists(path):
        return None
    try:
        reader = spark.read.schema(schema) if schema else spark.read
        found = reader.parquet(path)
        return found.select(*schema.names) if schema else found
    except AnalysisException as problem:
        if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
