"""Cleaned prices and enriched positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskrisk.functions import direction_multiplier, normalise_ticker
from deskrisk.operators import latest_per_key


def prices_cleaned(bronze: DataFrame, load_order: Sequence[str] = ("_ingested_at",)) -> DataFrame:
    """One row per ticker and day: complete prices only, the newest load winning.

    Gaps are not filled: an invented price would give a return of zero on a day
    without trading and so understate risk. ``load_order`` lists the columns that
    tell loads apart, most significant first.
    """
    prices = bronze.select(
        F.col("Date").cast("date").alias("price_date"),
        F.col("Open").cast("double").alias("open_price"),
        F.col("High").cast("double").alias("high_price"),
        F.col("Low").cast("double").alias("low_price"),
        F.col("Close").cast("double").alias("close_price"),
        F.col("Volume").cast("double").alias("volume"),
        normalise_ticker(F.col("ticker").cast("string")).alias("ticker"),
        F.col("fetched_at").cast("string").alias("fetched_at"),
        *[F.col(c).alias(f"_load_{c}") for c in load_order],
    ).na.drop(
        "any", subset=["price_date", "open_price", "high_price", "low_price", "close_price", "ticker"]
    )
    # The day comes first: it has more values than the ticker, so sorting is cheaper.
    newest = latest_per_key(prices, ["price_date", "ticker"], [f"_load_{c}" for c in load_order])
    return newest.drop(*[f"_load_{c}" for c in load_order])


def latest_rates(fx_rates: DataFrame, load_order: Sequence[str] = ("as_of_date", "_ingested_at")) -> DataFrame:
    """Newest rate per currency. The rates table grows by one load a day, and a
    currency listed twice would double every position in it."""
    rates = fx_rates.select(
        F.upper(F.col("currency").cast("string")).alias("currency"),
        F.col("rate_vs_usd").cast("double").alias("fx_rate_vs_usd"),
        *[c for c in load_order if c in fx_rates.columns],
    )
    order = [c for c in load_order if c in fx_rates.columns]
    if not order:
        return rates
    return rates.groupBy("currency").agg(F.max_by("fx_rate_vs_usd", F.struct(*order)).alias("fx_rate_vs_usd"))


def latest_prices(prices: DataFrame) -> DataFrame:
    """Newest close and its day per ticker."""
    return prices.groupBy("ticker").agg(
        F.max_by(F.col("close_price").cast("double"), "price_date").alias("current_price"),
        F.max("price_date").alias("latest_price_date"),
    )


def positions_enriched(
    bronze: DataFrame,
    fx_rates: DataFrame,
    prices: DataFrame | None,
    as_of: Column,
    load_order: Sequence[str] = ("generated_at",),
) -> DataFrame:
    """One row per trade, in USD, with the newest price of its ticker.

    A trade in a currency without a rate is dropped, so that the gap shows up as a
    missing row; a ticker without prices keeps its trade. ``prices`` may be None
    where no price column is needed. ``as_of`` is the day maturity is counted from.

    Neither join is hinted. Rates come from a small file, which Spark broadcasts by
    its size; the price side is measured at run time, while the trades are still in
    the shuffle of the deduplication, and is broadcast if it turns out small. If it
    does not, the trades are shuffled by ticker and a hot ticker is split.
    """
    newest = latest_per_key(bronze.where("trade_id IS NOT NULL"), ["trade_id"], load_order)
    return enrich(newest, fx_rates, None if prices is None else latest_prices(prices), as_of)


def enrich(newest: DataFrame, fx_rates: DataFrame, closes: DataFrame | None, as_of: Column) -> DataFrame:
    """``positions_enriched`` for one row per trade and one row per ticker (``latest_prices``)."""
    trades = newest.select(
        *[
            F.col(c).cast("string").alias(c)
            for c in (
                "trade_id", "desk", "book_id", "trader_id", "counterparty", "asset_class",
                "instrument_type", "ticker", "isin", "cusip", "direction",
            )
        ],
        F.col("notional").cast("double").alias("notional"),
        F.upper(F.col("currency").cast("string")).alias("currency"),
        F.col("trade_date").cast("date").alias("trade_date"),
        F.col("maturity_date").cast("date").alias("maturity_date"),
    )
    converted = trades.join(latest_rates(fx_rates), "currency")
    if closes is None:
        priced = converted.withColumns(
            {"current_price": F.lit(None).cast("double"), "latest_price_date": F.lit(None).cast("date")}
        )
    else:
        priced = converted.join(closes, "ticker", "left")
    multiplier = direction_multiplier(F.col("direction"))
    rate = F.col("fx_rate_vs_usd")
    return priced.select(
        "trade_id", "desk", "book_id", "trader_id", "counterparty", "asset_class", "instrument_type",
        "ticker", "isin", "cusip", "direction", "notional", "currency", "trade_date", "maturity_date",
        "fx_rate_vs_usd",
        (F.col("notional") * rate).alias("notional_usd"),
        "current_price", "latest_price_date",
        (F.coalesce("current_price", "notional") * rate).alias("market_value_usd"),
        F.datediff("maturity_date", as_of).alias("days_to_maturity"),
        multiplier.alias("direction_multiplier"),
        (F.col("notional") * rate * multiplier).alias("net_exposure_usd"),
    )
