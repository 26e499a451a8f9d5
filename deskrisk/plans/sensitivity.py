"""FX, equity, rates and credit sensitivities.

Every model here is one map-side combined aggregation of the positions; nothing is
joined to them before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from deskrisk.functions import same_text
from deskrisk.functions.columns import BASIS_POINT
from deskrisk.plans.book import trade_measures


def _count() -> Column:
    return F.sum("trades").cast("int").alias("position_count")


def _count_when(predicate: Column) -> Column:
    return F.sum(F.when(predicate, F.col("trades")).otherwise(0)).cast("int")


def fx_sensitivity(positions: DataFrame, run_date: Column) -> DataFrame:
    """Effect of a 1 % move of each foreign currency, by desk and asset class."""
    notional, side = F.col("notional_usd"), F.col("direction_multiplier")
    foreign = trade_measures(positions).where(~same_text(F.col("currency"), "USD"))
    grouped = foreign.groupBy("desk", "currency", "asset_class").agg(
        _count(),
        _count_when(same_text(F.col("direction"), "LONG")).alias("long_position_count"),
        _count_when(same_text(F.col("direction"), "SHORT")).alias("short_position_count"),
        F.sum("gross_usd").alias("gross_notional_usd"),
        F.sum(F.when(side == 1, notional).otherwise(0.0)).alias("long_notional_usd"),
        F.sum(F.when(side == -1, notional).otherwise(0.0)).alias("short_notional_usd"),
        F.sum("signed_usd").alias("net_notional_usd"),
        F.max("fx_rate_vs_usd").alias("fx_rate_vs_usd"),
    )
    net = F.col("net_notional_usd")
    return grouped.select(
        run_date.cast("date").alias("calculation_date"),
        "desk", "currency", "asset_class",
        "position_count", "long_position_count", "short_position_count",
        "gross_notional_usd", "long_notional_usd", "short_notional_usd", "net_notional_usd",
        F.greatest("long_notional_usd", F.abs("short_notional_usd")).alias("net_open_position_usd"),
        "fx_rate_vs_usd",
        (F.abs(net) * 0.01).alias("fx_delta_1pct_usd"),
        (net * 0.01).alias("fx_delta_up_1pct_usd"),
        (net * -0.01).alias("fx_delta_down_1pct_usd"),
    )


def classify(df: DataFrame, classifications: DataFrame) -> DataFrame:
    """Add ``sector`` and ``geography`` by ticker, regardless of case; else 'Unknown'."""
    known = classifications.groupBy(F.upper("ticker").alias("_ticker")).agg(
        F.max("sector").alias("_sector"), F.max("geography").alias("_geography")
    )
    return (
        df.join(known, F.upper("ticker") == F.col("_ticker"), "left")
        .withColumns(
            {
                "sector": F.coalesce("_sector", F.lit("Unknown")),
                "geography": F.coalesce("_geography", F.lit("Unknown")),
            }
        )
        .drop("_ticker", "_sector", "_geography")
    )


def equity_sensitivity(positions: DataFrame, classifications: DataFrame, run_date: Column) -> DataFrame:
    """Effect of a 1 % move of each equity, by desk. Tickers are classified after they
    have been summed, so each is looked up once."""
    notional = F.col("notional_usd")
    equities = trade_measures(positions).where(same_text(F.col("asset_class"), "EQUITY"))
    grouped = equities.groupBy("desk", "ticker").agg(
        _count(),
        _count_when(F.col("direction") == "LONG").alias("long_position_count"),
        _count_when(F.col("direction") == "SHORT").alias("short_position_count"),
        F.sum("gross_usd").alias("gross_notional_usd"),
        F.sum(F.when(F.col("direction") == "LONG", notional).otherwise(0.0)).alias("_long"),
        F.sum(F.when(F.col("direction") == "SHORT", notional).otherwise(0.0)).alias("_short"),
        F.sum("signed_usd").alias("net_notional_usd"),
        F.max("current_price").alias("current_price"),
        F.max("latest_price_date").alias("latest_price_date"),
    )
    net = F.col("net_notional_usd")
    return classify(grouped, classifications).select(
        run_date.cast("date").alias("calculation_date"),
        "desk", "ticker", "sector", "geography",
        "position_count", "long_position_count", "short_position_count",
        "gross_notional_usd", "net_notional_usd", "current_price", "latest_price_date",
        (F.abs(net) * 0.01).alias("equity_delta_1pct_usd"),
        (net * 0.01).alias("equity_delta_up_1pct_usd"),
        (net * -0.01).alias("equity_delta_down_1pct_usd"),
        (F.col("_long") * 0.01).alias("long_delta_usd"),
        (F.abs("_short") * 0.01).alias("short_delta_usd"),
    )


def rates_credit_sensitivity(positions: DataFrame, run_date: Column) -> DataFrame:
    """Effect of one basis point on rates and spreads, by tenor and currency.

    Matured trades carry no sensitivity but are counted. They are aggregated in the
    same pass, as a bucket of their own that a window then spreads over the live
    buckets of its desk, class and currency (five rows at most).

    Rates up or spreads wider means prices down, so a long book loses: that is the
    minus sign of the ``up`` and ``widen`` columns.
    """
    book = trade_measures(positions).where(F.upper("asset_class").isin("RATES", "CREDIT"))
    buckets = (
        book.groupBy(
            "desk", "asset_class", F.col("currency").alias("rate_currency"), F.col("live_tenor").alias("tenor_bucket")
        )
        .agg(
            _count(),
            F.sum("gross_usd").alias("gross_notional_usd"),
            F.sum("signed_usd").alias("net_notional_usd"),
            F.sum("gross_years").alias("_weighted"),
            F.sum("signed_years").alias("_signed_years"),
        )
    )
    curve = W.partitionBy("desk", "asset_class", "rate_currency")
    matured = F.max(F.when(F.col("tenor_bucket").isNull(), F.col("position_count"))).over(curve)
    live = buckets.withColumn("matured_position_count", F.coalesce(matured, F.lit(0))).where(
        "tenor_bucket IS NOT NULL"
    )
    one_bp = F.col("_signed_years") * F.lit(BASIS_POINT)

    def only(asset_class: str, value: Column, name: str) -> Column:
        return F.when(same_text(F.col("asset_class"), asset_class), value).otherwise(0.0).alias(name)

    return live.select(
        run_date.cast("date").alias("calculation_date"),
        "desk", "asset_class", "tenor_bucket", "rate_currency", "position_count", "matured_position_count",
        "gross_notional_usd", "net_notional_usd",
        (F.col("_weighted") / F.nullif("gross_notional_usd", F.lit(0.0))).alias("weighted_avg_duration_years"),
        only("RATES", F.abs(one_bp), "pv01_usd"),
        only("RATES", -one_bp, "pv01_up_1bp_usd"),
        only("RATES", one_bp, "pv01_down_1bp_usd"),
        only("RATES", F.abs(one_bp) * 100, "dv01_100bps_usd"),
        only("CREDIT", F.abs(one_bp), "cs01_usd"),
        only("CREDIT", -one_bp, "cs01_widen_1bp_usd"),
        only("CREDIT", one_bp, "cs01_tighten_1bp_usd"),
        only("CREDIT", F.abs(one_bp) * 100, "cs01_100bps_usd"),
    )
