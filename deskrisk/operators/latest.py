"""Newest row, or newest value, per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame, keys: Sequence[str], newest_first: Sequence[str | Column], keep: int = 1
) -> DataFrame:
    """Whole rows, the ``keep`` newest per key, ordered by ``newest_first`` descending.

    Written as ``row_number() <= keep`` because Spark then limits each key *before*
    the shuffle as well as after it (WindowGroupLimit): a key that holds a third of
    all rows still sends at most ``keep`` rows per input partition.
    """
    order = [F.desc(c) if isinstance(c, str) else c.desc() for c in newest_first]
    window = W.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("_row", F.row_number().over(window))
    return ranked.where(F.col("_row") <= keep).drop("_row")


def latest_value(df: DataFrame, keys: Sequence[str], order: str, **values: str) -> DataFrame:
    """``output=column`` pairs taken from the row with the greatest ``order`` per key.

    An aggregate, so it combines map-side and never sorts; use it when only a few
    columns of the newest row are needed.
    """
    return df.groupBy(*keys).agg(*[F.max_by(source, order).alias(name) for name, source in values.items()])
