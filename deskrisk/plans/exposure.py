"""Exposure against desk limits, and the log of limit breaches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from deskrisk.functions import band, flag
from deskrisk.operators import latest_per_key
from deskrisk.plans.book import trade_measures


def latest_limits(limits: DataFrame) -> DataFrame:
    """Most recently approved limit per desk, whatever its case; among equal days, the newest load."""
    order = [c for c in ("approved_date", "_ingested_at") if c in limits.columns]
    named = limits.withColumn("_desk", F.upper("desk"))
    return latest_per_key(named, ["_desk"], order).select("desk", F.col("limit_usd").cast("double").alias("limit_usd"))


def exposure_monitor(positions: DataFrame, limits: DataFrame, run_date: Column) -> DataFrame:
    """Gross and net exposure per desk, its limit and a traffic light.

    Desks are matched to limits regardless of case, and a desk without a limit has no
    row. A limit of zero is an input error and fails the division (ANSI mode) rather
    than passing as a green light.
    """
    notional = F.col("notional_usd")
    desks = trade_measures(positions).groupBy("desk").agg(
        F.sum("gross_usd").alias("gross_exposure_usd"),
        F.sum("net_exposure_usd").alias("net_exposure_usd"),
        F.sum(F.when(F.col("direction") == "LONG", notional).otherwise(0.0)).alias("long_exposure_usd"),
        F.sum(F.when(F.col("direction") == "SHORT", notional).otherwise(0.0)).alias("short_exposure_usd"),
        F.sum("trades").cast("int").alias("position_count"),
    )
    in_force = latest_limits(limits).select(F.upper("desk").alias("_desk"), "limit_usd")
    used = F.col("utilisation_pct")
    return (
        desks.join(in_force, F.upper("desk") == F.col("_desk"))
        .withColumn("utilisation_pct", F.round(F.col("gross_exposure_usd") / F.col("limit_usd") * 100, 4))
        .select(
            run_date.cast("date").alias("as_of_date"),
            "desk", "gross_exposure_usd", "net_exposure_usd", "limit_usd", "utilisation_pct",
            band(used, [(used >= 100, "RED"), (used >= 80, "AMBER")], "GREEN").alias("limit_status"),
            flag((used >= 80) & (used < 100)).alias("warning_flag"),
            flag(used >= 100).alias("breach_flag"),
            "long_exposure_usd", "short_exposure_usd", "position_count",
        )
    )


def breach_log_step(log: DataFrame | None, exposure: DataFrame, run_date: Column) -> DataFrame:
    """Rows of the breach log that one run day inserts or changes, to be merged.

    Open episodes and today's breaches meet in one full outer join by desk: on both
    sides, the breach goes on; only open, it has ended; only today, it is new. The log
    counts the first day as one day and later days by date difference, so the second
    day is also day one. Repeating a day changes nothing.
    """
    day = run_date.cast("date")
    today = exposure.where((F.col("as_of_date") == day) & flag(F.col("breach_flag"))).select(
        F.col("desk").alias("_today"),
        F.col("utilisation_pct").alias("_used"),
        F.col("limit_usd").alias("_limit"),
        F.col("gross_exposure_usd").alias("_gross"),
    )
    if log is None:
        return today.select(
            F.col("_today").alias("desk"),
            day.alias("breach_start_date"),
            F.lit(None).cast("date").alias("breach_end_date"),
            F.lit(1).alias("breach_duration_days"),
            F.lit(True).alias("is_active"),
            F.round("_used", 4).alias("peak_utilisation_pct"),
            day.alias("peak_utilisation_date"),
            F.round("_used", 4).alias("breach_start_utilisation_pct"),
            F.col("_limit").alias("limit_usd"),
            F.col("_gross").alias("gross_exposure_at_start_usd"),
            F.lit(None).cast("date").alias("warning_start_date"),
            F.lit(None).cast("int").alias("warning_duration_days"),
        )
    pair = log.where("is_active").join(today, F.col("desk") == F.col("_today"), "full_outer")
    is_new = F.col("desk").isNull()
    has_ended = F.col("_today").isNull()
    length = F.datediff(day, "breach_start_date")
    higher = F.col("_used") >= F.col("peak_utilisation_pct")
    return pair.select(
        F.coalesce("desk", "_today").alias("desk"),
        F.coalesce("breach_start_date", day).alias("breach_start_date"),
        F.when(has_ended, day).alias("breach_end_date"),
        F.when(is_new, 1)
        .when(has_ended, length)
        .otherwise(F.greatest(length, F.lit(1)))
        .alias("breach_duration_days"),
        (~has_ended).alias("is_active"),
        F.when(has_ended, F.col("peak_utilisation_pct"))
        .otherwise(F.round(F.greatest("peak_utilisation_pct", "_used"), 4))
        .alias("peak_utilisation_pct"),
        F.when(is_new | higher, day).otherwise(F.col("peak_utilisation_date")).alias("peak_utilisation_date"),
        F.coalesce("breach_start_utilisation_pct", F.round("_used", 4)).alias("breach_start_utilisation_pct"),
        F.when(is_new, F.col("_limit")).otherwise(F.col("limit_usd")).alias("limit_usd"),
        F.when(is_new, F.col("_gross"))
        .otherwise(F.col("gross_exposure_at_start_usd"))
        .alias("gross_exposure_at_start_usd"),
        "warning_start_date",
        "warning_duration_days",
    )


def breach_episodes(exposure: DataFrame) -> DataFrame:
    """The whole breach log from a history of exposures, without stepping through days.

    The run days are those of ``exposure``. A desk's episode is a stretch of
    consecutive run days on which it breached; it ends on the next run day, whether
    the desk is back under its limit then or has no exposure at all. Both windows hold
    one row per run day (of a desk), which is a short calendar.
    """
    calendar = (
        exposure.select("as_of_date")
        .distinct()
        .select(
            F.col("as_of_date").alias("_day"),
            F.row_number().over(W.orderBy("as_of_date")).alias("_number"),
            F.lead("as_of_date").over(W.orderBy("as_of_date")).alias("_next_day"),
        )
    )
    breaches = exposure.where(flag(F.col("breach_flag"))).join(
        calendar, F.col("as_of_date") == F.col("_day")
    )
    by_day = W.partitionBy("desk").orderBy("as_of_date")
    # Consecutive run days differ from the desk's own row number by a constant.
    islands = breaches.withColumn("_island", F.col("_number") - F.row_number().over(by_day))
    used = F.round("utilisation_pct", 4)
    episodes = islands.groupBy("desk", "_island").agg(
        F.min("as_of_date").alias("breach_start_date"),
        F.max("as_of_date").alias("_last_day"),
        F.max_by("_next_day", "as_of_date").alias("breach_end_date"),
        F.max(F.struct(used.alias("used"), "as_of_date")).alias("_peak"),
        F.min_by(used, "as_of_date").alias("breach_start_utilisation_pct"),
        F.min_by("limit_usd", "as_of_date").alias("limit_usd"),
        F.min_by("gross_exposure_usd", "as_of_date").alias("gross_exposure_at_start_usd"),
    )
    ended = F.col("breach_end_date").isNotNull()
    one_day = F.col("_last_day") == F.col("breach_start_date")
    return episodes.select(
        "desk", "breach_start_date", "breach_end_date",
        F.when(ended, F.datediff("breach_end_date", "breach_start_date"))
        .when(one_day, 1)
        .otherwise(F.datediff("_last_day", "breach_start_date"))
        .alias("breach_duration_days"),
        (~ended).alias("is_active"),
        F.col("_peak.used").alias("peak_utilisation_pct"),
        F.col("_peak.as_of_date").alias("peak_utilisation_date"),
        "breach_start_utilisation_pct", "limit_usd", "gross_exposure_at_start_usd",
        F.lit(None).cast("date").alias("warning_start_date"),
        F.lit(None).cast("int").alias("warning_duration_days"),
    )
