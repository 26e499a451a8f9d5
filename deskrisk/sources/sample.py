"""The sample star schema (orders, lineitem, ...) seen as a trading firm's bronze data.

Orders become trades, line items become prices and repeated loads, brands become
tickers and market segments become desks. (order, line number) is not unique, so
both deduplications have real work to do. All views are lazy DataFrames.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from deskrisk.functions import normalise_ticker, padded_id
from deskrisk.plans.book import trade_measures
from deskrisk.plans.silver import positions_enriched, prices_cleaned
from deskrisk.sources.schemas import SEEDS

RUN_DATE = "2001-12-31"

# Fixed values of the sample.
FX_RATES = "VALUES ('USD', 1.0D), ('EUR', 1.1D), ('GBP', 1.25D), ('JPY', 0.0067D), ('AUD', 0.65D)"
LIMITS = """VALUES
  ('FX Desk', 0.028D, DATE '2001-01-01'), ('FX Desk', 0.5D, DATE '1999-01-01'),
  ('Equity Desk', 0.043D, DATE '2001-01-01'), ('Equity Desk', 0.01D, DATE '1999-01-01'),
  ('Rates Desk', 0.080D, DATE '2001-01-01'), ('Credit Desk', 0.042D, DATE '2001-01-01'),
  ('Macro Desk', 0.025D, DATE '2001-01-01')"""
SCENARIOS = """VALUES
  ('Crash', 'Equity', -0.35D, NULL, 'REGULATORY', TRUE), ('Crash', 'FX', -0.12D, NULL, 'REGULATORY', TRUE),
  ('Crash', 'Rates', NULL, 250D, 'REGULATORY', TRUE), ('Crash', 'Credit', NULL, 450D, 'REGULATORY', TRUE),
  ('Rates Up', 'Rates', NULL, 200D, 'REGULATORY', FALSE), ('Rates Up', 'Credit', NULL, 50D, 'REGULATORY', FALSE),
  ('Equity Only', 'Equity', -0.25D, NULL, 'MANAGEMENT', FALSE)"""
DESKS = ("FX Desk", "Equity Desk", "Rates Desk", "Credit Desk", "Macro Desk")


def _pick(column: Column, pairs: dict, otherwise) -> Column:
    chain = None
    for key, value in pairs.items():
        chain = F.when(column == key, value) if chain is None else chain.when(column == key, value)
    return chain.otherwise(otherwise)


class Sample:
    """Bronze and silver views of the tables in ``folder``.

    ``spread`` hashes the big table before it is joined: for a sample that comes as one file,
    which one task would read, join and sort. Spark sizes the parts, so that they do not grow with
    the table. Without it the scan is left as it is.
    """

    def __init__(self, spark: SparkSession, folder: str, spread: bool = False):
        self.spark = spark
        self.spread = spread
        self.folder = folder.rstrip("/")

    @property
    def run_date(self) -> Column:
        return F.lit(RUN_DATE).cast("date")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def lineitem(self) -> DataFrame:
        """The big table; every view below does its work on it."""
        rows = self.table("lineitem")
        return rows.repartition("l_orderkey", "l_partkey") if self.spread else rows

    def _with_orders(self) -> DataFrame:
        """The big table with its orders; hashed ahead only where the join would not shuffle it."""
        orders = self.table("orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_orderdate")
        size = int(str(orders._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        small = size <= self.spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
        rows = self.lineitem if small else self.table("lineitem")
        return rows.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))

    @staticmethod
    def _brand() -> tuple[Column, Column]:
        number = F.substring("p_brand", 7, 10)
        return number, number.cast("int")

    def _symbol(self) -> Column:
        text, number = self._brand()
        return (
            F.when(number % 3 == 0, F.concat(F.lit("B"), text, F.lit("=X")))
            .when(number % 3 == 1, F.concat(F.lit("B"), text, F.lit(".L")))
            .otherwise(F.concat(F.lit("B"), text))
        )

    @cached_property
    def market_prices(self) -> DataFrame:
        price = F.col("l_extendedprice") / F.col("l_quantity")
        joined = self.lineitem.join(self.table("part"), F.col("l_partkey") == F.col("p_partkey"))
        return joined.select(
            F.col("l_shipdate").cast("date").alias("Date"),
            price.alias("Open"),
            (price * (1 + F.col("l_tax"))).alias("High"),
            (price * (1 - F.col("l_discount"))).alias("Low"),
            F.when(F.col("l_quantity") == 1, None).otherwise(price).alias("Close"),
            F.col("l_quantity").alias("Volume"),
            self._symbol().alias("ticker"),
            F.date_format("l_shipdate", "yyyy-MM").alias("fetched_at"),
            F.col("l_orderkey").alias("s1"), F.col("l_linenumber").alias("s2"),
            F.col("l_extendedprice").alias("s3"), F.col("l_partkey").alias("s4"),
            F.col("l_suppkey").alias("s5"), F.col("l_quantity").alias("s6"),
        )

    @cached_property
    def positions(self) -> DataFrame:
        key = F.col("l_orderkey")
        trade_id = padded_id("T-", key, 8)
        segments = dict(zip(("BUILDING", "MACHINERY", "AUTOMOBILE", "HOUSEHOLD"), DESKS))
        classes = dict(zip(segments, ("FX", "Equity", "Rates", "Credit")))
        mixed = F.when(key % 4 == 0, "FX").when(key % 4 == 1, "Equity").when(key % 4 == 2, "Rates").otherwise("Credit")
        asset_class = _pick(F.col("c_mktsegment"), classes, mixed)
        products = {"FX": "FX_FORWARD", "Equity": "EQUITY", "Rates": "CORPORATE_BOND"}
        regions = {"ASIA": "JPY", "EUROPE": "EUR", "MIDDLE EAST": "GBP", "AMERICA": "AUD"}
        digest = F.upper(F.md5(trade_id))
        joined = (
            self._with_orders()
            .join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .join(self.table("part"), F.col("l_partkey") == F.col("p_partkey"))
        )
        return joined.select(
            trade_id.alias("trade_id"),
            _pick(F.col("c_mktsegment"), segments, "Macro Desk").alias("desk"),
            F.concat(F.lit("BOOK-"), F.substring("o_orderpriority", 1, 1)).alias("book_id"),
            F.concat(F.lit("T-"), (F.col("o_custkey") % 5).cast("string")).alias("trader_id"),
            F.col("n_name").alias("counterparty"),
            asset_class.alias("asset_class"),
            _pick(asset_class, products, "CDS").alias("instrument_type"),
            normalise_ticker(self._symbol()).alias("ticker"),
            F.when(asset_class != "FX", F.substring(digest, 1, 12)).alias("isin"),
            F.when(asset_class == "Equity", F.substring(digest, 13, 9)).alias("cusip"),
            F.when(F.col("o_orderstatus") == "F", "LONG")
            .when(F.col("o_orderstatus") == "O", "SHORT")
            .otherwise("FLAT")
            .alias("direction"),
            F.col("l_extendedprice").alias("notional"),
            _pick(F.col("r_name"), regions, "USD").alias("currency"),
            F.col("o_orderdate").cast("date").alias("trade_date"),
            F.date_add(F.col("l_shipdate").cast("date"), F.col("p_size") * 120).alias("maturity_date"),
            F.col("l_shipdate").alias("generated_at"),
            F.col("l_linenumber").alias("s2"), F.col("l_extendedprice").alias("s3"),
            F.col("l_partkey").alias("s4"), F.col("l_suppkey").alias("s5"),
        )

    @cached_property
    def fx_rates(self) -> DataFrame:
        return self.spark.sql(FX_RATES).toDF("currency", "rate_vs_usd")

    @cached_property
    def desk_limits(self) -> DataFrame:
        """Limits as fractions of all line items' value."""
        total = self.table("lineitem").agg(F.sum("l_extendedprice").alias("total"))
        shares = self.spark.sql(LIMITS).toDF("desk", "fraction", "approved_date")
        # One row: the total of a global aggregate.
        return shares.crossJoin(total).select(
            "desk", (F.col("fraction") * F.col("total")).alias("limit_usd"), "approved_date"
        )

    @cached_property
    def stress_scenarios(self) -> DataFrame:
        return self.spark.sql(SCENARIOS).toDF(*SEEDS["stress_scenarios"].names)

    @cached_property
    def ticker_classifications(self) -> DataFrame:
        """Brands from 23 up stay unclassified on purpose."""
        text, number = self._brand()
        return (
            self.table("part")
            .where(number <= 22)
            .select(
                F.concat(F.lit("B"), text, F.when(number % 3 == 1, "_L").otherwise("")).alias("ticker"),
                F.when(number % 4 == 0, "Technology").when(number % 4 == 1, "Financials")
                .when(number % 4 == 2, "Energy").otherwise("Health").alias("sector"),
                F.when(number % 3 == 0, "Asia").when(number % 3 == 1, "UK").otherwise("US").alias("geography"),
            )
            .distinct()
        )

    @cached_property
    def prices_cleaned(self) -> DataFrame:
        return prices_cleaned(self.market_prices, load_order=("s1", "s2", "s3", "s4", "s5", "s6"))

    def _enriched(self, prices: DataFrame | None) -> DataFrame:
        return positions_enriched(
            self.positions, self.fx_rates, prices, self.run_date, load_order=("generated_at", "s2", "s3", "s4", "s5")
        )

    @cached_property
    def positions_enriched(self) -> DataFrame:
        return self._enriched(self.prices_cleaned)

    @cached_property
    def positions_unpriced(self) -> DataFrame:
        """For models that use no price: the price join is left out of the plan."""
        return self._enriched(None)

    def pnl_history(self, positions: DataFrame, prices: DataFrame) -> DataFrame:
        """P&L of today's book on every day with a return, by desk."""
        book = trade_measures(positions).groupBy("desk", "ticker").agg(F.sum("signed_usd").alias("_signed"))
        previous = F.lag("close_price").over(W.partitionBy("ticker").orderBy("price_date"))
        moves = prices.select("ticker", "price_date", "close_price", previous.alias("_previous")).where("_previous > 0")
        move = (F.col("close_price") - F.col("_previous")) / F.col("_previous")
        return (
            book.join(moves, "ticker")
            .groupBy("desk", F.col("price_date").alias("pnl_date"))
            .agg(F.sum(F.col("_signed") * move).alias("actual_pnl_usd"))
        )

    def exposure_history(self, positions: DataFrame, unit: str = "month") -> DataFrame:
        """Notional booked per month (or other unit) against a limit of 1.1 times the desk's mean one."""
        monthly = positions.groupBy("desk", F.trunc("trade_date", unit).alias("as_of_date")).agg(
            F.sum("notional_usd").alias("gross_exposure_usd")
        )
        limit = F.avg("gross_exposure_usd").over(W.partitionBy("desk")) * 1.1
        used = F.col("gross_exposure_usd") / F.col("limit_usd") * 100
        return monthly.withColumn("limit_usd", limit).withColumns(
            {"utilisation_pct": used, "breach_flag": used >= 100}
        )
