"""Quality gates of each table: a profile and an ordered verdict, in one aggregation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskrisk.operators.checks import verdict
from deskrisk.plans.statuses import STATUSES

# The closed domains of the book.
ASSET_CLASSES = ("FX", "Equity", "Rates", "Credit")
DIRECTIONS = ("LONG", "SHORT")
DESK_CLASS = {"FX Desk": "FX", "Equity Desk": "Equity", "Rates Desk": "Rates", "Credit Desk": "Credit"}


def broken(gate: str) -> list[tuple[str, Column]]:
    """The statuses of a gate and when each holds: its count is above zero."""
    return [(status, F.col(column) > 0) for column, status in STATUSES[gate]]


def _rows() -> Column:
    return F.count(F.lit(1)).alias("total_rows")


def _distinct(column: str, name: str) -> Column:
    return F.countDistinct(column).alias(name)


def _few(column: str, name: str) -> Column:
    """Distinct values of a dimension, gathered map-side: a second COUNT(DISTINCT) would repeat every row."""
    return F.size(F.collect_set(column)).cast("long").alias(name)


def _nulls(**named: str) -> list[Column]:
    return [F.count_if(F.col(c).isNull()).alias(name) for name, c in named.items()]


def _count(name: str, predicate: Column) -> Column:
    return F.count_if(predicate).alias(name)


def prices_gate(prices: DataFrame) -> DataFrame:
    """Profile of cleaned prices. The null counts are NULL, not zero, when nothing is
    NULL, as the sum of no rows; the verdict treats both alike."""

    def nulls(column: str, name: str) -> Column:
        return F.sum(F.when(F.col(column).isNull(), 1)).alias(name)

    # One row per key first: distinct keys, tickers and days all follow from these, and only one of
    # them is left as a COUNT(DISTINCT), as a second one would repeat every row.
    by_key = prices.groupBy("ticker", "price_date").agg(
        F.count(F.lit(1)).alias("_rows"),
        nulls("close_price", "_null_close"),
        F.count_if(F.col("close_price") <= 0).alias("_non_positive"),
    )

    def of(column: str, name: str) -> Column:
        return F.sum(F.when(F.col(column).isNull(), F.col("_rows"))).alias(name)

    whole_key = F.col("ticker").isNotNull() & F.col("price_date").isNotNull()
    profile = by_key.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("total_rows"),
        _distinct("ticker", "unique_tickers"),
        _few("price_date", "unique_dates"),  # a calendar
        F.min("price_date").alias("earliest_date"),
        F.max("price_date").alias("latest_date"),
        of("price_date", "null_price_date"),
        of("ticker", "null_ticker"),
        F.sum("_null_close").alias("null_close_price"),
        (F.coalesce(F.sum("_rows"), F.lit(0)) - F.count_if(whole_key)).alias("duplicate_rows"),
        F.coalesce(F.sum("_non_positive"), F.lit(0)).alias("non_positive_close_price"),
    )
    return profile.withColumn("quality_status", verdict(broken("prices_gate")))


def positions_gate(positions: DataFrame) -> DataFrame:
    """Profile of enriched positions."""
    profile = positions.agg(
        _rows(),
        _distinct("trade_id", "unique_trades"),
        _few("desk", "unique_desks"),
        _few("currency", "unique_currencies"),
        *_nulls(
            null_trade_id="trade_id", null_notional_usd="notional_usd",
            null_fx_rate="fx_rate_vs_usd", null_net_exposure="net_exposure_usd",
        ),
        (F.count(F.lit(1)) - F.countDistinct("trade_id")).alias("duplicate_trade_ids"),
        _count("non_positive_notional", F.col("notional_usd") <= 0),
        _count("invalid_direction", ~F.col("direction_multiplier").isin(1, -1)),
        _count("positions_with_price", F.col("current_price").isNotNull()),
        _count("positions_without_price", F.col("current_price").isNull()),
    )
    return profile.withColumn("quality_status", verdict(broken("positions_gate")))


def desk_breakdown(positions: DataFrame) -> DataFrame:
    """Trades and totals by desk, largest first."""
    return (
        positions.groupBy("desk")
        .agg(
            F.count(F.lit(1)).alias("position_count"),
            _distinct("counterparty", "unique_counterparties"),
            _few("asset_class", "unique_asset_classes"),
            F.round(F.sum("notional_usd"), 2).alias("total_notional_usd"),
            F.round(F.sum("net_exposure_usd"), 2).alias("net_exposure_usd"),
            _count("long_positions", F.col("direction") == "LONG"),
            _count("short_positions", F.col("direction") == "SHORT"),
        )
        .orderBy(F.desc("total_notional_usd"))
    )


def silver_summary(prices: DataFrame, positions: DataFrame) -> DataFrame:
    """Row and key counts of the silver tables; the key of positions is the desk."""
    def line(name: str, df: DataFrame, key: str) -> DataFrame:
        return df.agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"), _distinct(key, "unique_tickers")
        )

    return line("prices_cleaned", prices, "ticker").unionByName(
        line("positions_enriched", positions, "desk")
    ).orderBy("table_name")


def var_gate(var: DataFrame) -> DataFrame:
    """VaR must be present, positive and rise with the level; few scenarios only warn."""
    profile = var.agg(
        _rows(),
        _few("desk", "unique_desks"),
        _few("asset_class", "unique_asset_classes"),
        _distinct("calculation_date", "unique_dates"),
        *_nulls(
            null_var_95="var_95_usd", null_var_97_5="var_97_5_usd", null_var_99="var_99_usd",
            null_var_10day="var_10day_97_5_usd", null_es="es_97_5_usd", null_notional="total_notional_usd",
        ),
        _count("var_97_5_less_than_95", F.col("var_97_5_usd") < F.col("var_95_usd")),
        _count("var_99_less_than_97_5", F.col("var_99_usd") < F.col("var_97_5_usd")),
        _count("es_less_than_var", F.col("es_97_5_usd") < F.col("var_97_5_usd")),
        _count("tenday_less_than_oneday", F.col("var_10day_97_5_usd") < F.col("var_97_5_usd")),
        _count("non_positive_var_95", F.col("var_95_usd") <= 0),
        _count("non_positive_es", F.col("es_97_5_usd") <= 0),
        _count("low_scenario_count", F.col("scenario_count") < 200),
    )
    return profile.withColumn("quality_status", verdict(broken("var_gate")))


def pnl_gate(pnl: DataFrame) -> DataFrame:
    """Unexplained P&L must tie out with actual less hypothetical, to a cent."""
    gap = F.col("unexplained_pnl_usd") - (F.col("actual_pnl_usd") - F.col("hypothetical_pnl_usd"))
    profile = pnl.agg(
        _rows(),
        _few("desk", "unique_desks"),
        _distinct("pnl_date", "unique_dates"),
        *_nulls(
            null_hypothetical="hypothetical_pnl_usd", null_actual="actual_pnl_usd",
            null_unexplained="unexplained_pnl_usd",
        ),
        _count("pnl_mismatch_rows", F.abs(gap) > 0.01),
    )
    return profile.withColumn("quality_status", verdict(broken("pnl_gate")))


def backtest_gate(backtest: DataFrame) -> DataFrame:
    """Magnitudes belong to exceptions only, and zones agree with the counts."""
    excess, exception = F.col("exception_magnitude"), F.col("is_exception")
    zone, rolling = F.col("basel_zone"), F.col("rolling_250d_exceptions")
    profile = backtest.agg(
        _rows(),
        _few("desk", "unique_desks"),
        _distinct("backtest_date", "unique_dates"),
        *_nulls(
            null_var="var_97_5_usd", null_actual_loss="actual_loss_usd",
            null_rolling_count="rolling_250d_exceptions", null_basel_zone="basel_zone",
        ),
        _count("magnitude_on_non_exception", ~exception & excess.isNotNull()),
        _count("missing_magnitude_on_exception", exception & (excess.isNull() | (excess <= 0))),
        _count("red_zone_mismatch", (zone == "RED") & (rolling < 10)),
        _count("amber_zone_mismatch", (zone == "AMBER") & ((rolling < 5) | (rolling >= 10))),
        _count("total_exceptions", exception),
        _count("total_non_exceptions", ~exception),
        _count("green_rows", zone == "GREEN"),
        _count("amber_rows", zone == "AMBER"),
        _count("red_rows", zone == "RED"),
    )
    return profile.withColumn("quality_status", verdict(broken("backtest_gate")))


def exposure_gate(exposure: DataFrame) -> DataFrame:
    """The traffic light and the two flags must tell the same story."""
    status, warns, breaches = F.col("limit_status"), F.col("warning_flag"), F.col("breach_flag")
    profile = exposure.agg(
        _rows(),
        _few("desk", "unique_desks"),
        *_nulls(
            null_gross_exposure="gross_exposure_usd", null_limit="limit_usd",
            null_utilisation="utilisation_pct", null_limit_status="limit_status",
        ),
        _count("negative_gross_exposure", F.col("gross_exposure_usd") < 0),
        _count("non_positive_limit", F.col("limit_usd") <= 0),
        _count("negative_utilisation", F.col("utilisation_pct") < 0),
        _count("red_flag_mismatch", (status == "RED") & (~breaches | warns)),
        _count("amber_flag_mismatch", (status == "AMBER") & (~warns | breaches)),
        _count("green_flag_mismatch", (status == "GREEN") & (warns | breaches)),
        _count("invalid_status_values", ~status.isin("RED", "AMBER", "GREEN")),
        _count("red_desks", status == "RED"),
        _count("amber_desks", status == "AMBER"),
        _count("green_desks", status == "GREEN"),
    )
    return profile.withColumn("quality_status", verdict(broken("exposure_gate")))


def gold_summary(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows, desks and newest date of each ``name: (table, date column)``."""
    lines = [
        df.agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("row_count"),
            _few("desk", "unique_desks"),
            F.max(date_col).alias("latest_date"),
        )
        for name, (df, date_col) in tables.items()
    ]
    return reduce(DataFrame.unionByName, lines).orderBy("table_name")


def bronze_load_audit(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows per load of each ``name: (table, column with the load's stamp)``."""
    lines = [
        df.groupBy(F.col(stamp).cast("string").alias("load_stamp"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(name).alias("table_name"), "load_stamp", "row_count")
        for name, (df, stamp) in tables.items()
    ]
    return reduce(DataFrame.unionByName, lines).orderBy("table_name", "load_stamp")


def validate_book(book: DataFrame) -> DataFrame:
    """The rules a trading book must meet before it lands, with the first one broken."""
    fx, equity = F.col("asset_class") == "FX", F.col("asset_class") == "Equity"
    isin, cusip = F.col("isin"), F.col("cusip")
    off_mandate = F.lit(False)
    for desk, asset_class in DESK_CLASS.items():
        off_mandate = off_mandate | ((F.col("desk") == desk) & ~F.col("asset_class").eqNullSafe(asset_class))
    profile = book.agg(
        _rows(),
        (F.count(F.lit(1)) - F.countDistinct("trade_id")).alias("duplicate_trade_ids"),
        _count("bad_asset_class", F.coalesce(~F.col("asset_class").isin(*ASSET_CLASSES), F.lit(True))),
        _count("bad_direction", F.coalesce(~F.col("direction").isin(*DIRECTIONS), F.lit(True))),
        _count("bad_notional", F.coalesce(F.col("notional") <= 0, F.lit(True))),
        _count("bad_isin", F.length(isin) != 12),
        _count("bad_cusip", F.length(cusip) != 9),
        _count("fx_with_isin", fx & isin.isNotNull()),
        _count("fx_with_cusip", fx & cusip.isNotNull()),
        _count("equity_without_isin", equity & isin.isNull()),
        _count("desk_class_mismatch", off_mandate),
    )
    return profile.withColumn("quality_status", verdict(broken("validate_book")))


def book_profile(book: DataFrame) -> DataFrame:
    """Trades and ISIN coverage by desk, class and product."""
    return (
        book.groupBy("desk", "asset_class", "instrument_type")
        .agg(F.count("trade_id").alias("trades"), F.count("isin").alias("with_isin"))
        .orderBy("desk", "asset_class", "instrument_type")
    )
