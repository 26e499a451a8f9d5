"""Landing zone: dated CSV folders in, bronze rows out."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import partial, reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from deskrisk.functions import normalise_ticker
from deskrisk.operators.scratch import together
from deskrisk.sources.versions import EmptyLoadError, replace_table

# Fixed format of a dated landing folder.
DATED_GLOB = "year=*/month=*/day=*/*.csv"
AUDIT = ("_source_file", "_ingested_at")
# The text of a row that does not fit its file's header.
LINE = "_line"


class MissingInputError(FileNotFoundError):
    """An input file an earlier step should have written is not there."""


class HeaderError(ValueError):
    """The header of a file that must be loaded does not name the columns it should."""


def text_schema(schema: StructType) -> StructType:
    """The same columns as text, without the audit ones: what a CSV file holds."""
    return StructType([StructField(f.name, StringType()) for f in schema if f.name not in AUDIT])


def typed(raw: DataFrame, schema: StructType) -> DataFrame:
    """Cast text columns to ``schema`` and add the file path and load time.

    Columns the file has beyond ``schema`` are kept as text, so that an evolving
    source loses nothing. A value that cannot be cast stops the load (ANSI mode).
    """
    wanted = [f for f in schema if f.name not in AUDIT]
    present = {c.lower(): c for c in raw.columns}
    columns: list[Column] = []
    for f in wanted:
        source = F.col(present[f.name.lower()]) if f.name.lower() in present else F.lit(None)
        columns.append(source.cast(f.dataType).alias(f.name))
    known = {f.name.lower() for f in wanted}
    columns += [F.col(c) for c in raw.columns if c.lower() not in known and not c.startswith("_")]
    return raw.select(
        *columns,
        F.col("_metadata.file_path").alias("_source_file"),
        F.current_timestamp().alias("_ingested_at"),
    )


def read_landing(
    spark: SparkSession, folder: str, schema: StructType, pattern: str = DATED_GLOB
) -> DataFrame:
    """All landing files below ``folder``: header row, no type inference, typed columns.

    ``schema`` names the columns in file order, as text files carry no types.
    """
    raw = (
        spark.read.schema(text_schema(schema))
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")  # a row of another length stops the load
        .csv(f"{folder.rstrip('/')}/{pattern}")
    )
    return typed(raw, schema)


def file_headers(spark: SparkSession, paths: Sequence[str]) -> dict[str, list[str]]:
    """Header lines and the files that begin with each; files without a line have none.

    Of each file only the start is read, by a job of one task that ends at the first line, so that the
    cost goes with the number of files and not with their size. What reaches the driver is a name and a
    line per file.
    """

    def first(path: str) -> Row | None:
        # In the first block alone, as further blocks of a file are tasks of their own.
        lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
        return lines.where("block = 0 AND length(trim(value)) > 0").head()

    files = [unquote(f) for f in spark.read.text(list(paths)).inputFiles()]
    rows = together({f: partial(first, f) for f in files}).values()
    found: dict[str, list[str]] = {}
    for r in sorted((r for r in rows if r is not None), key=lambda r: r.file):
        found.setdefault(r.value.lstrip("\ufeff"), []).append(r.file)
    return found


def header_columns(line: str) -> list[str]:
    return [name.strip() for name in next(csv.reader([line]))]


def header_problem(names: Sequence[str], schema: StructType, new_columns: bool) -> str | None:
    """Why files with these columns cannot be taken; None when they can.

    Without ``new_columns`` the header must name the columns of ``schema``, in any order.
    """
    lower = [n.lower() for n in names]
    if any(not n or n.startswith("_") for n in lower):
        return "a column name is empty or reserved"
    if len(set(lower)) < len(lower):
        return "a column name is repeated"
    want = {f.name.lower() for f in schema if f.name not in AUDIT}
    if not new_columns and (gap := want ^ set(lower)):
        return "other columns than declared: " + ", ".join(sorted(gap))
    return None


def read_by_header(
    spark: SparkSession, schema: StructType, headers: dict[str, list[str]], mode: str = "PERMISSIVE"
) -> DataFrame:
    """Rows of files with the columns their own headers name, matched regardless of case and order.

    Columns of ``schema`` come first, typed, NULL where a file lacks them; others follow as text. A
    row that has another number of fields, or a field that is not of its type, keeps its whole
    text in ``_line`` (with ``mode="FAILFAST"`` it stops the load).
    """
    declared = {f.name.lower(): f for f in schema if f.name not in AUDIT}
    parts = []
    for header, files in headers.items():
        fields = [declared.get(n.lower(), StructField(n, StringType())) for n in header_columns(header)]
        raw = (
            spark.read.schema(StructType([*fields, StructField(LINE, StringType())]))
            .option("header", True)
            .option("mode", mode)
            .option("columnNameOfCorruptRecord", LINE)
            .option("columnPruning", False)  # every field of a row is looked at, whatever is selected
            .csv(files)
        )
        have = {f.name for f in fields}
        parts.append(
            raw.select(
                *[F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in declared.values()],
                *[F.col(f"`{f.name}`") for f in fields if f.name.lower() not in declared],
                F.col("_metadata.file_path").alias("_source_file"), F.current_timestamp().alias("_ingested_at"), LINE,
            )
        )
    if not parts:
        known = [*declared.values(), *[StructField(n, t) for n, t in (("_source_file", StringType()), ("_ingested_at", TimestampType()), (LINE, StringType()))]]
        return spark.createDataFrame([], StructType(known))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_required(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """One CSV file or folder that must exist, its columns matched by the header.

    A header without all declared columns, or a row that does not fit, is an error.
    """
    try:
        headers = file_headers(spark, [path])
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            raise MissingInputError(f"{path} does not exist; did the step before it run?") from problem
        raise
    for header in headers:
        lacking = {f.name.lower() for f in schema if f.name not in AUDIT} - {n.lower() for n in header_columns(header)}
        problem = header_problem(header_columns(header), schema, new_columns=True)
        if lacking or problem:
            raise HeaderError(f"{path}: {problem or 'lacks ' + ', '.join(sorted(lacking))}")
    return read_by_header(spark, schema, headers, mode="FAILFAST").drop(LINE)


def append(df: DataFrame, table_path: str) -> None:
    """Load again whatever is given, seen before or not."""
    df.write.mode("append").parquet(table_path)


def truncate_reload(df: DataFrame, table_path: str) -> int:
    """Replace the table with ``df`` and return its row count.

    An empty load is an error and leaves the table as it was.
    """
    return replace_table(df, table_path, least_rows=1)


def full_refresh(df: DataFrame, table_path: str) -> None:
    """Rebuild a table from scratch; a job that fails leaves the old one. See ``versions``."""
    replace_table(df, table_path)


def evolve(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Rows of both, with the columns of both; a side without a column has NULL there."""
    return existing.unionByName(incoming, allowMissingColumns=True)


def evolve_append(df: DataFrame, table_path: str, known: StructType | None = None) -> DataFrame:
    """Append rows that may bring new columns and return the table as it now reads.

    Parquet files each carry their own columns, so old files need no rewrite; a column
    a file lacks reads as NULL. ``known`` is the table's column list so far; without
    it, the list is put together from the footers of all files.
    """
    spark = df.sparkSession
    if known is None:
        try:
            known = spark.read.option("mergeSchema", True).parquet(table_path).schema
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            known = df.schema
    types = {f.name: f.dataType for f in known}
    clash = [
        f"{f.name}: {types[f.name].simpleString()} and {f.dataType.simpleString()}"
        for f in df.schema
        if types.get(f.name, f.dataType) != f.dataType
    ]
    if clash:
        raise ValueError("column types changed: " + "; ".join(clash))
    append(df, table_path)
    grown = StructType([*known, *[f for f in df.schema if f.name not in types]])
    return spark.read.schema(grown).parquet(table_path)


def write_landing(df: DataFrame, folder: str, date_col: str) -> None:
    """Write CSV below ``year=/month=/day=`` folders, replacing only the days in ``df``.

    ``date_col`` is the run day; it names the folder and is not part of the file.
    """
    dated = df.withColumns(
        {
            "year": F.date_format(date_col, "yyyy"),
            "month": F.date_format(date_col, "MM"),
            "day": F.date_format(date_col, "dd"),
        }
    ).drop(date_col)
    (
        dated.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .partitionBy("year", "month", "day")
        .csv(folder)
    )


def landing_path(ticker: Column, run_date: Column) -> Column:
    """Relative path of a ticker's file for one day."""
    return F.concat(
        F.lit("year="), F.date_format(run_date, "yyyy"),
        F.lit("/month="), F.lpad(F.month(run_date).cast("string"), 2, "0"),
        F.lit("/day="), F.lpad(F.dayofmonth(run_date).cast("string"), 2, "0"),
        F.lit("/"), normalise_ticker(ticker), F.lit(".csv"),
    )


def landing_inventory(spark: SparkSession, folder: str, prefix: str = "") -> DataFrame:
    """Files below ``folder`` whose relative path starts with ``prefix``.

    Listing only: file contents are never read, as the column is not selected.
    """
    root = folder.rstrip("/")
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(root)
        .select("path", "length", "modificationTime")
    )
    relative = F.substring_index(F.col("path"), root + "/", -1)
    return files.select(
        relative.alias("filename"),
        F.round(F.col("length") / F.lit(1024.0), 1).alias("size_kb"),
        F.col("modificationTime").alias("last_modified"),
    ).where(F.startswith("filename", F.lit(prefix)))


def skip_landed(planned: DataFrame, landed: DataFrame, key: Sequence[str] | str) -> DataFrame:
    """Planned work whose file has not landed yet."""
    return planned.join(landed, key, "left_anti")


def normalise_market_data(raw: DataFrame, ticker: Column, fetched_at: Column) -> DataFrame:
    """Vendor download to landing layout: lower-case names, symbol and fetch time added,
    a volume of zero read as "not reported", columns in fixed order, absent ones left out."""
    lower = raw.toDF(*[c.lower() for c in raw.columns]).withColumns(
        {"ticker": ticker, "fetched_at": fetched_at}
    )
    if "volume" in lower.columns:
        lower = lower.withColumn("volume", F.nullif(F.col("volume"), F.lit(0).cast(lower.schema["volume"].dataType)))
    order = ("date", "open", "high", "low", "close", "volume", "ticker", "fetched_at")
    return lower.select(*[c for c in order if c in lower.columns])


def fx_rates_from_prices(prices: DataFrame, run_date: Column) -> DataFrame:
    """Spot rates: newest close of each currency pair against USD, plus USD itself at 1.

    ``prices`` holds pairs only, as ``date, close, ticker`` with tickers like EURUSD=X.
    No rows at all is an error, as rates would then silently be missing.
    """
    if prices.isEmpty():
        raise EmptyLoadError("no prices to take FX rates from")
    pair = normalise_ticker(F.col("ticker"))
    day = F.col("date").cast("date")
    newest = (
        prices.select(F.replace(pair, F.lit("USD"), F.lit("")).alias("currency"), day.alias("date"), "close")
        .groupBy("currency")
        .agg(F.max_by("close", "date").alias("close"), F.max("date").alias("as_of_date"))
        .select("currency", F.round(F.col("close").cast("double"), 6).alias("rate_vs_usd"), "as_of_date")
    )
    usd = prices.sparkSession.range(1).select(
        F.lit("USD").alias("currency"), F.lit(1.0).alias("rate_vs_usd"), run_date.cast("date").alias("as_of_date")
    )
    return newest.unionByName(usd)
