"""Queries a risk manager asks of the gold tables."""

from __future__ import annotations

from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deskrisk.functions import same_text
from deskrisk.operators import together
from deskrisk.sources.lake import Lake
from deskrisk.sources.schemas import TABLES

ALL = "ALL"
# The desks a report may be asked for.
DESKS = ("FX Desk", "Equity Desk", "Rates Desk", "Credit Desk")


class UnknownDeskError(ValueError):
    """The desk asked for is not one of the desks there are."""


def desk_argument(desk: str, desks: Iterable[str] = DESKS) -> str | None:
    """The desk as spelled in ``desks``, matched regardless of case; None for ALL."""
    if desk == ALL:
        return None
    for known in desks:
        if desk.upper() == known.upper():
            return known
    raise UnknownDeskError(f"invalid desk {desk!r}; valid desks: {', '.join(sorted(desks))}")


def newest(df: DataFrame, date_col: str) -> DataFrame:
    """Rows of the newest date. The subquery's value reaches the scan as a filter, so
    a table partitioned by ``date_col`` is read for that date only."""
    return df.where(F.col(date_col) == df.agg(F.max(date_col)).scalar())


def _of_desk(df: DataFrame, desk: str, desks: Iterable[str]) -> DataFrame:
    wanted = desk_argument(desk, desks)
    return df if wanted is None else df.where(same_text(F.col("desk"), wanted))


def var_report(var: DataFrame, desk: str = ALL, desks: Iterable[str] = DESKS) -> DataFrame:
    """Newest VaR, largest first."""
    return (
        _of_desk(newest(var, "calculation_date"), desk, desks)
        .select("desk", "asset_class", "var_95_usd", "var_99_usd", "calculation_date")
        .orderBy(F.desc("var_99_usd"))
    )


def active_breaches(exposure: DataFrame) -> DataFrame:
    """Desks over their limit on the newest day, worst first."""
    return (
        newest(exposure, "as_of_date")
        .where("breach_flag")
        .select(
            "desk", "gross_exposure_usd", "limit_usd", F.round("utilisation_pct", 4).alias("utilisation_pct"),
            "limit_status", "breach_flag",
        )
        .orderBy(F.desc("utilisation_pct"))
    )


def pnl_summary(pnl: DataFrame, desk: str = ALL, desks: Iterable[str] = DESKS) -> DataFrame:
    """Newest P&L by desk, the largest unexplained part first."""
    return (
        _of_desk(newest(pnl, "pnl_date"), desk, desks)
        .orderBy(F.desc(F.abs(F.col("actual_pnl_usd") - F.col("hypothetical_pnl_usd"))))
        .select(
            "desk",
            F.round("actual_pnl_usd", 2).alias("actual_pnl_usd"),
            F.round("hypothetical_pnl_usd", 2).alias("hypothetical_pnl_usd"),
            F.round("unexplained_pnl_usd", 2).alias("unexplained_pnl_usd"),
            "pnl_date",
        )
    )


def table_health(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Row count of each ``name: path``; a table that cannot be read gets its error
    instead and does not stop the others. Counts come from Parquet footers."""
    lines = []
    for name, path in paths.items():
        try:
            lines.append((name, spark.read.parquet(path).count(), None))
        except PySparkException as problem:
            lines.append((name, None, problem.getCondition() or type(problem).__name__))
    return spark.createDataFrame(lines, "table_name string, row_count bigint, error string")


def lake_health(lake: Lake) -> DataFrame:
    """``table_health`` of every declared table, however it is written.

    Each count is one job that reads footers on the executors; they run side by side, and what one
    of them ends with is a row like any other.
    """
    def count(table: str) -> tuple:
        try:
            found = lake.find(table)
            return (None, "MISSING") if found is None else (found.count(), None)
        except PySparkException as problem:
            return None, problem.getCondition() or type(problem).__name__
        except Py4JJavaError as problem:  # a job that failed: its condition is the cause's
            failure = problem.java_exception
            return None, failure.getCondition() if hasattr(failure, "getCondition") else str(failure.getClass().getName())

    counted = together({table: lambda table=table: count(table) for table in TABLES})
    return lake.spark.createDataFrame(
        [(table, *counted[table]) for table in TABLES], "table_name string, row_count bigint, error string"
    )


def desk_filter(df: DataFrame, desks: Iterable[str]) -> DataFrame:
    """Only the rows of the desks a reader may see."""
    return df.where(F.col("desk").isin(list(desks)))
