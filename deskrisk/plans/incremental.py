"""Silver and its state, from new loads alone.

Bronze that was ingested comes in numbered batches. A table remembers the last batch it took, so a
day's run reads the batches after it and no older file. New prices replace those of their months,
new trades those of their buckets (a hash of the trade); other months and buckets are neither read
nor written. The number is noted last: a run that ends before is repeated with the same result.
Bronze without batches is taken whole each time.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from deskrisk.operators import latest_per_key, settle
from deskrisk.operators.checks import write_rules
from deskrisk.operators.files import Files
from deskrisk.plans.silver import prices_cleaned
from deskrisk.sources.lake import Lake
from deskrisk.sources.schemas import STATE, TABLES
from deskrisk.streaming.ingest import is_ingested, last_batch, read_ingested

# Folders the trades are dealt into: one should fit a few tasks. Fixed for the life of a table.
BUCKETS = 64


class BucketError(ValueError):
    """A table was dealt into another number of buckets."""


def _note(lake: Lake, table: str) -> str:
    return f"{lake.path(table)}__taken"


def fresh(lake: Lake, bronze: str, table: str) -> tuple[DataFrame, dict]:
    """Bronze rows that ``table`` has not taken, and the note to leave once it has."""
    spark, path = lake.spark, lake.path(bronze)
    if not is_ingested(spark, path):
        return lake.read(bronze), {}
    files = Files(spark)
    taken = json.loads(files.read(_note(lake, table))) if files.exists(_note(lake, table)) else {}
    rows = read_ingested(spark, path, after=taken.get("batch"))
    lacking = [f for f in TABLES[bronze] if f.name not in rows.columns]
    rows = rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in lacking})
    return rows.select(*TABLES[bronze].names), taken | {"batch": last_batch(spark, path)}


def _taken(lake: Lake, table: str, note: dict) -> None:
    Files(lake.spark).write(_note(lake, table), json.dumps(note), replace=True)


def month_closes(prices: DataFrame) -> DataFrame:
    """Newest and second newest close of each ticker and month; a month's group is some 20 days."""
    newest = W.partitionBy("price_month", "ticker").orderBy(F.desc("price_date"))
    two = prices.select("price_month", "ticker", "price_date", "close_price", F.row_number().over(newest).alias("_row")).where("_row <= 2")

    def of(row: int, column: str, name: str) -> Column:
        return F.max(F.when(F.col("_row") == row, F.col(column))).alias(name)

    return two.groupBy("price_month", "ticker").agg(
        of(1, "price_date", "last_date"), of(1, "close_price", "last_close"),
        of(2, "price_date", "prior_date"), of(2, "close_price", "prior_close"),
    )


def take_prices(lake: Lake) -> None:
    """Merge new price loads into ``prices_cleaned``, and renew the closes of their months.

    Batches are merged in the order they landed in, so a price that comes again replaces the older one.
    """
    rows, note = fresh(lake, "market_prices", "prices_cleaned")
    dated = prices_cleaned(rows).withColumn("price_month", F.trunc("price_date", "month"))
    incoming = settle(dated.withColumn("_silver_loaded_at", F.current_timestamp()), "new-prices")
    keys = ["price_month", "price_date", "ticker"]
    not_null = [f.name for f in TABLES["prices_cleaned"] if not f.nullable]
    rules = write_rules(incoming, not_null, non_positive_close_price=F.col("close_price") <= 0)
    lake.merge_state("prices_cleaned", incoming, keys, "price_month", rules=rules)
    touched = lake.prices().join(incoming.select("price_month").distinct(), "price_month", "left_semi")
    lake.merge_state("month_closes", month_closes(touched).select(*STATE["month_closes"].names), ["price_month", "ticker"], "price_month")
    _taken(lake, "prices_cleaned", note)


def take_trades(lake: Lake, buckets: int = BUCKETS) -> None:
    """Merge new loads of trades into ``trades_latest``, where the newest load of each trade stays."""
    rows, note = fresh(lake, "positions", "trades_latest")
    if note.get("buckets", buckets) != buckets:
        raise BucketError(f"trades_latest has {note['buckets']} buckets, not {buckets}")
    newest_by = ["generated_at", "_ingested_at"]
    newest = latest_per_key(rows.where("trade_id IS NOT NULL"), ["trade_id"], newest_by)
    bucket = F.pmod(F.xxhash64("trade_id"), F.lit(buckets)).cast("int")
    incoming = newest.withColumn("trade_bucket", bucket).select(*STATE["trades_latest"].names)
    lake.merge_state("trades_latest", incoming, ["trade_bucket", "trade_id"], "trade_bucket", newest_by=newest_by)
    _taken(lake, "trades_latest", note | {"buckets": buckets})


def newest_closes(months: DataFrame) -> DataFrame:
    """``latest_prices`` of silver, from one row per ticker and month."""
    return months.groupBy("ticker").agg(
        F.max_by("last_close", "last_date").alias("current_price"), F.max("last_date").alias("latest_price_date")
    )
