"""Daily P&L attribution and performance relative to risk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from deskrisk.functions import band
from deskrisk.plans.book import trade_measures
from deskrisk.plans.value_at_risk import desk_var


def price_moves(prices: DataFrame, run_date: Column, months: DataFrame | None = None) -> DataFrame:
    """Return between the two newest days of each ticker up to ``run_date``.

    NULL when there is only one day or the earlier close is zero. With ``months`` (``month_closes``),
    only the month of the run date is read of the prices, which have it in ``price_month``; the two
    newest days of each earlier month are in ``months``.
    """
    newest = W.partitionBy("ticker").orderBy(F.desc("price_date"))
    day = run_date.cast("date")
    closes = prices.where(F.col("price_date") <= day)
    if months is not None:
        month = F.trunc(day, "month")
        days = [F.struct(F.col(f"{k}_date").alias("price_date"), F.col(f"{k}_close").alias("close_price")) for k in ("last", "prior")]
        earlier = months.where(F.col("price_month") < month).select("ticker", F.inline(F.array(*days)))
        closes = closes.where(F.col("price_month") == month).select("ticker", "price_date", "close_price").unionByName(
            earlier.where("price_date IS NOT NULL")
        )
    two = (
        closes.select("ticker", "price_date", "close_price", F.dense_rank().over(newest).alias("_day"))
        .where("_day <= 2")
    )
    pivoted = two.groupBy("ticker").agg(
        F.max(F.when(F.col("_day") == 1, F.col("close_price"))).alias("_last"),
        F.max(F.when(F.col("_day") == 2, F.col("close_price"))).alias("_prior"),
    )
    return pivoted.select(
        "ticker", ((F.col("_last") - F.col("_prior")) / F.nullif("_prior", F.lit(0.0))).alias("daily_return")
    )


def pnl_attribution(
    positions: DataFrame, prices: DataFrame, run_date: Column, noise: str = "hash", months: DataFrame | None = None
) -> DataFrame:
    """Hypothetical, actual and unexplained P&L per desk.

    Trades whose ticker has no price are left out; a ticker with a single day counts
    with a return of zero. ``noise`` names the stand-in for what moves the actual P&L
    besides the market (see ``trade_noise``); a book already has it in its sums. As in VaR, trades are summed per ticker
    before the join: the noise belongs to the trade, but both sums are linear in the
    return.
    """
    noisy = F.col("noisy_usd")
    book = trade_measures(positions, noise).groupBy("desk", "ticker").agg(
        F.sum("signed_usd").alias("_hypothetical"),
        F.sum(noisy).alias("_actual"),
        F.sum(F.when(F.col("direction") == "LONG", noisy).otherwise(0.0)).alias("_long"),
        F.sum(F.when(F.col("direction") == "SHORT", noisy).otherwise(0.0)).alias("_short"),
        F.sum("trades").alias("_trades"),
    )
    move = F.coalesce("daily_return", F.lit(0.0))
    return (
        book.join(price_moves(prices, run_date, months), "ticker")
        .groupBy("desk")
        .agg(
            F.sum(F.col("_hypothetical") * move).alias("hypothetical_pnl_usd"),
            F.sum(F.col("_actual") * move).alias("actual_pnl_usd"),
            F.sum("_trades").cast("int").alias("position_count"),
            F.sum(F.col("_long") * move).alias("long_pnl_usd"),
            F.sum(F.col("_short") * move).alias("short_pnl_usd"),
        )
        .select(
            run_date.cast("date").alias("pnl_date"),
            "desk", "hypothetical_pnl_usd", "actual_pnl_usd",
            (F.col("actual_pnl_usd") - F.col("hypothetical_pnl_usd")).alias("unexplained_pnl_usd"),
            "position_count", "long_pnl_usd", "short_pnl_usd",
        )
    )


def risk_adjusted_performance(
    pnl: DataFrame, var: DataFrame, exposure: DataFrame, run_date: Column
) -> DataFrame:
    """P&L against the VaR and the limit it used, for every desk with P&L that day."""
    day = run_date.cast("date")
    earned = pnl.where(F.col("pnl_date") == day).select("desk", "actual_pnl_usd", "unexplained_pnl_usd")
    used = exposure.where(F.col("as_of_date") == day).select(
        "desk", F.col("utilisation_pct").alias("limit_utilisation_pct")
    )
    actual, risk = F.col("actual_pnl_usd"), F.col("var_99_usd")
    used_pct = F.col("limit_utilisation_pct")
    return (
        earned.join(desk_var(var, run_date, "var_99_usd"), "desk", "left")
        .join(used, "desk", "left")
        .select(
            day.alias("calculation_date"), "desk", "actual_pnl_usd", "var_99_usd",
            F.when(risk > 0, F.round(actual / risk, 4)).alias("pnl_to_var_ratio"),
            "limit_utilisation_pct",
            F.when(used_pct > 0, actual / used_pct).alias("pnl_per_unit_utilisation"),
            F.when(F.abs(actual) > 0, F.round(F.col("unexplained_pnl_usd") / F.abs(actual) * 100, 4))
            .otherwise(0.0)
            .alias("unexplained_pnl_pct"),
            band(actual, [(actual > risk, "STRONG"), (actual > 0, "ADEQUATE")], "LOSS").alias("performance_flag"),
        )
    )
