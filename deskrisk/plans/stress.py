"""Named stress scenarios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskrisk.functions import percent_of, same_text
from deskrisk.functions.columns import BASIS_POINT
from deskrisk.plans.book import trade_measures
from deskrisk.plans.exposure import latest_limits
from deskrisk.plans.value_at_risk import desk_var


def stress_testing(
    positions: DataFrame, scenarios: DataFrame, var: DataFrame, limits: DataFrame, run_date: Column
) -> DataFrame:
    """P&L of each desk under each scenario that shocks a class it holds.

    A shock is a relative price move (``shock_pct``) or a rise of yields or spreads in
    basis points (``shock_bps``), which costs a long position its duration times the
    rise. Both are linear in sums over trades, so the book is reduced to one row per
    desk and class, and only that meets the scenarios.
    """
    book = trade_measures(positions).groupBy("desk", "asset_class").agg(
        F.sum("trades").alias("_trades"),
        F.sum("gross_usd").alias("_gross"),
        F.sum("signed_usd").alias("_signed"),
        F.sum("signed_years").alias("_signed_years"),
    )
    portfolio = book.agg(F.sum("_gross").alias("portfolio_total_notional_usd"))

    shocks = scenarios.select(
        "scenario_name",
        F.upper("asset_class").alias("_class"),
        F.col("shock_pct").cast("double").alias("_pct"),
        F.col("shock_bps").cast("double").alias("_bps"),
        "scenario_type",
        F.col("is_stressed_var_proxy").cast("boolean").alias("is_stressed_var_proxy"),
    )
    pnl = (
        F.when(F.col("_pct").isNotNull(), F.col("_signed") * F.col("_pct"))
        .when(F.col("_bps").isNotNull(), -F.col("_signed_years") * F.col("_bps") * F.lit(BASIS_POINT))
        .otherwise(0.0)
    )
    by_class = (
        book.join(shocks, F.upper("asset_class") == F.col("_class"))
        .withColumn("_pnl", pnl)
        .groupBy("desk", "scenario_name", "asset_class")
        .agg(
            F.max("scenario_type").alias("scenario_type"),
            F.bool_or("is_stressed_var_proxy").alias("is_stressed_var_proxy"),
            F.max("_trades").alias("_trades"),
            F.sum("_gross").alias("_gross"),
            F.sum("_pnl").alias("_pnl"),
        )
    )

    def part(asset_class: str) -> Column:
        mine = same_text(F.col("asset_class"), asset_class)
        return F.sum(F.when(mine, F.col("_pnl")).otherwise(0.0)).alias(f"stressed_pnl_{asset_class.lower()}_usd")

    stressed = by_class.groupBy("desk", "scenario_name").agg(
        F.max("scenario_type").alias("scenario_type"),
        F.bool_or("is_stressed_var_proxy").alias("is_stressed_var_proxy"),
        F.sum("_trades").cast("int").alias("position_count"),
        F.sum("_gross").alias("total_notional_usd"),
        F.sum("_pnl").alias("stressed_pnl_usd"),
        part("EQUITY"), part("FX"), part("RATES"), part("CREDIT"),
        F.min(F.struct("_pnl", "asset_class")).alias("_worst"),
    )
    in_force = latest_limits(limits).select(
        F.upper("desk").alias("_limit_desk"), F.col("limit_usd").alias("desk_limit_usd")
    )
    size = F.abs("stressed_pnl_usd")
    return (
        # One row: the total of a global aggregate.
        stressed.crossJoin(portfolio)
        .join(desk_var(var, run_date, "var_99_usd"), "desk", "left")
        .join(in_force, F.upper("desk") == F.col("_limit_desk"), "left")
        .select(
            run_date.cast("date").alias("calculation_date"),
            "desk", "scenario_name", "scenario_type", "is_stressed_var_proxy", "position_count",
            "total_notional_usd", "portfolio_total_notional_usd",
            percent_of(F.col("total_notional_usd"), F.col("portfolio_total_notional_usd")).alias("coverage_pct"),
            "stressed_pnl_usd", "stressed_pnl_equity_usd", "stressed_pnl_fx_usd",
            "stressed_pnl_rates_usd", "stressed_pnl_credit_usd",
            F.col("_worst.asset_class").alias("worst_asset_class"),
            F.col("_worst._pnl").alias("worst_asset_class_pnl_usd"),
            "var_99_usd",
            F.when(F.col("var_99_usd") > 0, F.round(size / F.col("var_99_usd"), 4)).alias("stressed_loss_to_var_ratio"),
            "desk_limit_usd",
            F.when(F.col("desk_limit_usd") > 0, F.round(size / F.col("desk_limit_usd") * 100, 4)).alias(
                "stressed_loss_to_limit_pct"
            ),
        )
    )
