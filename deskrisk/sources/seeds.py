"""Reference data kept as CSV files: typed on read, an empty field is NULL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from deskrisk.sources.schemas import SEEDS


def read_seed(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The seed ``name`` ("stress_scenarios" or "ticker_classifications") from ``path``."""
    return (
        spark.read.schema(SEEDS[name])
        .option("header", True)
        .option("mode", "FAILFAST")
        .csv(path)
    )
