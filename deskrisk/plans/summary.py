"""Executive summary: one row per desk and day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskrisk.functions import band, percent_of
from deskrisk.plans.value_at_risk import desk_var


def risk_summary(
    var: DataFrame,
    exposure: DataFrame,
    pnl: DataFrame,
    backtest: DataFrame,
    stress: DataFrame,
    concentration: DataFrame,
    run_date: Column,
) -> DataFrame:
    """Key figures of six gold tables for every desk that has VaR on ``run_date``.

    The other tables may lack the desk; its columns are then NULL, and a NULL never
    raises the status. All inputs but the last hold a few rows per desk and day, and
    from the last only the top counterparty of each desk is read.
    """
    day = run_date.cast("date")
    risk = desk_var(var, run_date, "total_notional_usd", "var_99_usd", "var_10day_97_5_usd", "es_97_5_usd")
    limits = exposure.where(F.col("as_of_date") == day).select(
        "desk", "gross_exposure_usd", "limit_usd", "utilisation_pct", "limit_status", "breach_flag"
    )
    earned = pnl.where(F.col("pnl_date") == day).select(
        "desk", "actual_pnl_usd", "hypothetical_pnl_usd", "unexplained_pnl_usd"
    )
    tested = backtest.where(F.col("backtest_date") == day).select("desk", "rolling_250d_exceptions", "basel_zone")
    worst = (
        stress.where(F.col("calculation_date") == day)
        .groupBy("desk")
        .agg(F.min(F.struct("stressed_pnl_usd", "scenario_name")).alias("_worst"))
        .select(
            "desk",
            F.col("_worst.scenario_name").alias("worst_stress_scenario"),
            F.col("_worst.stressed_pnl_usd").alias("worst_stress_pnl_usd"),
        )
    )
    largest = concentration.where(
        (F.col("as_of_date") == day) & (F.col("concentration_type") == "COUNTERPARTY") & (F.col("desk_rank") == 1)
    ).select(
        "desk",
        F.col("entity_name").alias("largest_counterparty"),
        F.round("pct_of_desk_total", 4).alias("largest_counterparty_pct"),
    )
    joined = risk
    for other in (limits, earned, tested, worst, largest):
        joined = joined.join(other, "desk", "left")
    loss, limit = F.abs("worst_stress_pnl_usd"), F.col("limit_usd")
    status = band(
        loss,
        [
            (F.col("breach_flag"), "RED"),
            (F.col("basel_zone") == "RED", "RED"),
            (loss > limit * 2, "RED"),
            (F.col("utilisation_pct") >= 80, "AMBER"),
            (F.col("basel_zone") == "AMBER", "AMBER"),
            (loss > limit, "AMBER"),
        ],
        "GREEN",
    )
    return joined.select(
        day.alias("summary_date"), "desk", "total_notional_usd", "var_99_usd", "var_10day_97_5_usd", "es_97_5_usd",
        percent_of(F.col("var_99_usd"), F.col("total_notional_usd")).alias("var_as_pct_of_notional"),
        "actual_pnl_usd", "hypothetical_pnl_usd", "unexplained_pnl_usd",
        "gross_exposure_usd", "limit_usd", "utilisation_pct", "limit_status",
        "rolling_250d_exceptions", "basel_zone", "worst_stress_scenario", "worst_stress_pnl_usd",
        "largest_counterparty", "largest_counterparty_pct", status.alias("overall_risk_status"),
    )
