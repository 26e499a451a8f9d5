"""The tables of one environment as Parquet folders ``<root>/<layer>/<table>``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from deskrisk.operators.checks import refuse
from deskrisk.operators.upsert import merge_into, read_table, schema_guard
from deskrisk.sources.landing import evolve
from deskrisk.sources.schemas import DATED, GOLD, KEYS, LAYERS, SILVER, TABLES, UPDATES
from deskrisk.sources.versions import current_folder, replace_table
from deskrisk.streaming.ingest import is_ingested, read_ingested

_LAYER = {table: layer for layer, tables in LAYERS.items() for table in tables}


class Lake:
    """Reads and writes the declared tables below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{_LAYER[table]}/{table}"

    def paths(self) -> dict[str, str]:
        """Layer-qualified names of all tables loaded by the pipeline, and their folders."""
        return {f"{layer}.{t}": self.path(t) for layer, tables in LAYERS.items() for t in tables}

    def read(self, table: str) -> DataFrame:
        """The table; an empty one when it was never written."""
        found = self.find(table)
        return self.spark.createDataFrame([], TABLES[table]) if found is None else found

    def find(self, table: str) -> DataFrame | None:
        """The table however it is written: by versions, by ingested batches, or as plain files."""
        path, schema = self.path(table), TABLES[table]
        if is_ingested(self.spark, path):
            return evolve(self.spark.createDataFrame([], schema), read_ingested(self.spark, path)).select(*schema.names)
        return read_table(self.spark, current_folder(self.spark, path) or path, schema)

    def replace(self, table: str, df: DataFrame, rules: dict[str, Column] | None = None) -> None:
        """Full refresh of a silver table, stamped with the write time.

        ``rules`` count offending rows while they are written; a count above zero raises
        ``QualityError`` and leaves the old table in force.
        """
        stamped = df.withColumn("_silver_loaded_at", F.current_timestamp())
        replace_table(
            schema_guard(stamped, SILVER[table]), self.path(table),
            accept=lambda seen, _: refuse(seen, table), **(rules or {}),
        )

    def prices(self) -> DataFrame:
        """Cleaned prices with their month, by which they are stored."""
        month = StructField("price_month", DateType())
        stored = StructType([*TABLES["prices_cleaned"], month])
        found = read_table(self.spark, self.path("prices_cleaned"), stored)
        return self.spark.createDataFrame([], stored) if found is None else found

    def merge(self, table: str, df: DataFrame, rules: dict[str, Column] | None = None) -> None:
        """Upsert into a gold table, stamped with the write time. ``rules`` are as in ``replace``."""
        stamped = df.withColumn("_gold_loaded_at", F.current_timestamp())
        merge_into(
            self.spark, self.path(table), schema_guard(stamped, GOLD[table]),
            KEYS[table], UPDATES[table], DATED[table], rules=rules,
        )

    def merge_state(
        self, table: str, df: DataFrame, keys: Sequence[str], partition_col: str,
        newest_by: Sequence[str] = (), rules: dict[str, Column] | None = None,
    ) -> None:
        """Upsert whole rows into a table of silver or state, which is stored by ``partition_col``."""
        merge_into(self.spark, self.path(table), df, keys, None, partition_col, newest_by, rules)
