"""Data-quality checks.

A check returns one row: ``check_name, failures``. A gate profiles a whole table in
one aggregation and names the first rule that fails in ``quality_status``.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class QualityError(RuntimeError):
    """A check or gate failed, so later steps must not run."""


def _result(df: DataFrame, name: str, failures: Column) -> DataFrame:
    return df.agg(F.coalesce(failures, F.lit(0)).cast("bigint").alias("failures")).select(
        F.lit(name).alias("check_name"), "failures"
    )


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows in which ``column`` is NULL."""
    return _result(df, f"not_null_{column}", F.count_if(F.col(column).isNull()))


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Values of ``column`` that occur more than once, NULL aside."""
    return check_unique_combination(df, [column])


def check_unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key combinations that occur more than once. A single NULL key is not a duplicate.

    Keys are counted map-side first, so a key repeated by the million is one row of
    the shuffle per input partition.
    """
    keyed = df.where(F.col(columns[0]).isNotNull()) if len(columns) == 1 else df
    counted = keyed.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    return _result(counted, "unique_" + "_".join(columns), F.count_if(F.col("_n") > 1))


def check_accepted_values(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Rows whose ``column`` is outside ``values``. NULL passes; see ``check_not_null``."""
    return _result(df, f"accepted_{column}", F.count_if(~F.col(column).isin(list(values))))


def run_checks(checks: Iterable[DataFrame]) -> DataFrame:
    """The rows of several checks."""
    return reduce(DataFrame.unionByName, checks)


def column_checks(
    df: DataFrame, not_null: Sequence[str] = (), accepted: dict[str, Sequence] | None = None
) -> DataFrame:
    """NOT NULL and accepted-value checks of many columns, in one scan of ``df``."""
    rules = {f"not_null_{c}": F.col(c).isNull() for c in not_null}
    rules |= {f"accepted_{c}": ~F.col(c).isin(list(v)) for c, v in (accepted or {}).items()}
    counts = df.agg(*[F.count_if(rule).alias(name) for name, rule in rules.items()])
    entries = [F.struct(F.lit(n).alias("check_name"), F.col(n).alias("failures")) for n in rules]
    return counts.select(F.inline(F.array(*entries)))


def write_rules(df: DataFrame, not_null: Sequence[str] = (), accepted: dict[str, Sequence] | None = None, **broken: Column) -> dict[str, Column]:
    """Counts of offending rows by rule, to be taken while ``df`` is written (see ``refuse``)."""
    rules = {f"not_null_{c}": F.col(c).isNull() for c in not_null}
    rules |= {f"accepted_{c}": ~F.col(c).isin(list(v)) for c, v in (accepted or {}).items() if c in df.columns}
    return {name: F.count_if(rule) for name, rule in (rules | broken).items()}


def refuse(seen: dict, what: str) -> None:
    """Raise when a rule of ``write_rules`` counted rows; ``rows``, their number, is not a rule."""
    bad = [f"{name}: {count}" for name, count in sorted(seen.items()) if name != "rows" and count]
    if bad:
        raise QualityError(f"{what}: " + "; ".join(bad))


def verdict(rules: Sequence[tuple[str, Column]], otherwise: str = "PASS") -> Column:
    """Label of the first rule whose predicate holds."""
    chain = None
    for label, broken in rules:
        chain = F.when(broken, label) if chain is None else chain.when(broken, label)
    return chain.otherwise(otherwise).alias("quality_status")


def stop_on_fail(results: DataFrame, what: str) -> None:
    """Raise when a check has failures or a gate's status is a FAIL. One small row per
    check reaches the driver; a WARN passes."""
    if "quality_status" in results.columns:
        bad = [r.quality_status for r in results.where("quality_status LIKE 'FAIL%'").collect()]
    else:
        bad = [f"{r.check_name}: {r.failures}" for r in results.where("failures > 0").collect()]
    if bad:
        raise QualityError(f"{what}: " + "; ".join(bad))
