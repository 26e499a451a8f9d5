"""``row_number`` within groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from deskrisk.operators.scratch import settle


def rank_rows(df: DataFrame, keys: Sequence[str], by: str, ties: Sequence[str], name: str) -> DataFrame:
    """Add ``name``: position within ``keys`` by ``by`` descending, then ``ties``.

    The rows are sorted into ranges of (keys, by, ties) and stored with the number of their
    range. Rows are numbered within a range, and each range of a group starts after the rows
    of the group's earlier ones. A group of any size, and any number of equal values, is so
    spread over many tasks; only the counts of the ranges are gathered by group.
    """
    order = [F.desc(by), *[F.asc(c) for c in ties]]
    ranged = settle(
        df.repartitionByRange(*[F.asc(k) for k in keys], *order).withColumn("_range", F.spark_partition_id()), f"ranged-{name}"
    )
    earlier = W.partitionBy(*keys).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        ranged.groupBy(*keys, "_range")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .drop("_n")
    )
    numbered = ranged.withColumn("_within", F.row_number().over(W.partitionBy(*keys, "_range").orderBy(*order)))
    return (
        _null_safe_join(numbered, starts, [*keys, "_range"])
        .withColumn(name, (F.col("_start") + F.col("_within")).cast("int"))
        .drop("_range", "_start", "_within")
    )


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = None
    for k in keys:
        match = left[k].eqNullSafe(renamed[f"_r_{k}"])
        condition = match if condition is None else condition & match
    return left.join(renamed, condition).drop(*[f"_r_{k}" for k in keys])
