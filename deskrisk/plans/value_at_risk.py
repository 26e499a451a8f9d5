"""Historical-simulation VaR, expected shortfall and the backtest of VaR."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from deskrisk.functions import basel_zone, flag, model_status
from deskrisk.operators import latest_per_key
from deskrisk.plans.book import trade_measures

# Calendar days of scenarios, tail probabilities, days of the backtest.
LOOKBACK_DAYS = 365
TAILS = {"var_95_usd": 0.05, "var_97_5_usd": 0.025, "var_99_usd": 0.01}
BACKTEST_ROWS = 250


def _newest_day(prices: DataFrame, months: DataFrame, as_of: Column | None) -> Column:
    """Newest day with a price, up to ``as_of``; of the prices, only the month of ``as_of`` is read."""
    if as_of is None:
        return months.agg(F.max("last_date")).scalar()
    month = F.trunc(as_of, "month")
    inside = prices.where((F.col("price_month") == month) & (F.col("price_date") <= as_of))
    earlier = months.where(F.col("price_month") < month)
    return F.greatest(inside.agg(F.max("price_date")).scalar(), earlier.agg(F.max("last_date")).scalar())


def _lookback(
    prices: DataFrame, lookback_days: int, as_of: Column | None, months: DataFrame | None
) -> tuple[DataFrame, DataFrame]:
    """Closes of the look-back, and closes before it of which each ticker needs the newest."""
    closes = prices if as_of is None else prices.where(F.col("price_date") <= as_of)
    columns = ("ticker", "price_date", "close_price")
    if months is None:
        first_day = F.date_sub(closes.agg(F.max("price_date")).scalar(), lookback_days)
        return closes.where(F.col("price_date") >= first_day).select(*columns), closes.where(F.col("price_date") < first_day).select(*columns)
    first_day = F.date_sub(_newest_day(prices, months, as_of), lookback_days)
    month, first_month = F.col("price_month"), F.trunc(first_day, "month")
    if as_of is not None:
        closes = closes.where(month <= F.trunc(as_of, "month"))
    recent = closes.where((month >= first_month) & (F.col("price_date") >= first_day)).select(*columns)
    same_month = closes.where((month == first_month) & (F.col("price_date") < first_day)).select(*columns)
    earlier = months.where(month < first_month).select(
        "ticker", F.col("last_date").alias("price_date"), F.col("last_close").alias("close_price")
    )
    return recent, same_month.unionByName(earlier)


def daily_returns(
    prices: DataFrame, lookback_days: int = LOOKBACK_DAYS, as_of: Column | None = None, months: DataFrame | None = None
) -> DataFrame:
    """Return per ticker and day over the days up to ``lookback_days`` before the newest price.

    Only the look-back itself is shuffled. Of the history before it, each ticker needs
    just its newest close, which is aggregated map-side; a window over all history
    would move every price ever stored. With ``months`` (``month_closes``), ``prices`` has its month
    in ``price_month``, and only the months of the look-back are read, which is known at run time.
    """
    recent, older = _lookback(prices, lookback_days, as_of, months)
    before = (
        older.groupBy("ticker")
        .agg(F.max_by("close_price", "price_date").alias("close_price"))
        # Only its place before the look-back matters, not the day itself.
        .select("ticker", F.lit(None).cast("date").alias("price_date"), "close_price")
    )
    # NULL sorts first, so the carried-over close precedes the look-back.
    ordered = W.partitionBy("ticker").orderBy(F.asc_nulls_first("price_date"))
    previous = F.lag("close_price").over(ordered)
    return (
        recent.unionByName(before)
        .withColumn("_previous", previous)
        .where(F.col("price_date").isNotNull() & (F.col("_previous") > 0))
        .select(
            "ticker",
            "price_date",
            ((F.col("close_price") - F.col("_previous")) / F.col("_previous")).alias("daily_return"),
        )
    )


def scenario_pnl(positions: DataFrame, returns: DataFrame) -> DataFrame:
    """P&L of today's book per desk, asset class and past day.

    P&L is linear in the notional, so trades are summed per ticker before the join:
    what meets the returns is one row per desk, class and ticker, however many trades
    there are and however many of them share one ticker.
    """
    book = trade_measures(positions).groupBy("desk", "asset_class", "ticker").agg(
        F.sum("signed_usd").alias("_signed"),
        F.sum("notional_usd").alias("_notional"),
        F.sum("trades").alias("_trades"),
    )
    return (
        book.join(returns, "ticker")
        .groupBy("desk", "asset_class", F.col("price_date").alias("scenario_date"))
        .agg(
            F.sum(F.col("_signed") * F.col("daily_return")).alias("pnl_usd"),
            F.sum("_notional").alias("notional_usd"),
            F.sum("_trades").alias("trades"),
        )
    )


def var_daily(
    positions: DataFrame,
    prices: DataFrame,
    run_date: Column,
    as_of: Column | None = None,
    lookback_days: int = LOOKBACK_DAYS,
    months: DataFrame | None = None,
) -> DataFrame:
    """VaR at three levels and expected shortfall per desk and asset class.

    ``positions`` has one row per trade, or is a book of them. The look-back ends at the newest price, or at
    ``as_of``. VaR is the size of the tail quantile, so a book that gains even there
    still shows a positive number. Percentiles interpolate over at most one value per
    day of the look-back, so a group is small whatever the book's size.
    """
    scenarios = scenario_pnl(positions, daily_returns(prices, lookback_days, as_of, months))
    # The quantiles are attached to the scenarios by a window, so that the tail average
    # needs neither a second pass nor a join back.
    group = W.partitionBy("desk", "asset_class")
    with_tails = scenarios.withColumn(
        "_tails", F.percentile("pnl_usd", list(TAILS.values())).over(group)
    )
    at = {name: F.abs(F.col("_tails")[i]) for i, name in enumerate(TAILS)}
    pnl = F.col("pnl_usd")
    measured = (
        with_tails.withColumns(at)
        .groupBy("desk", "asset_class")
        .agg(
            F.max("trades").cast("int").alias("position_count"),
            F.max("notional_usd").alias("total_notional_usd"),
            *[F.first(name).alias(name) for name in TAILS],
            F.abs(F.avg(F.when(pnl < -F.col("var_97_5_usd"), pnl))).alias("_shortfall"),
            F.avg("pnl_usd").alias("avg_daily_return_usd"),
            F.min("pnl_usd").alias("worst_day_loss_usd"),
            F.max("pnl_usd").alias("best_day_gain_usd"),
            F.count(F.lit(1)).cast("int").alias("scenario_count"),
        )
    )
    ten_days = F.sqrt(F.lit(10.0))
    return measured.select(
        run_date.cast("date").alias("calculation_date"),
        "desk", "asset_class", "position_count", "total_notional_usd", *TAILS,
        (F.col("var_95_usd") * ten_days).alias("var_10day_95_usd"),
        (F.col("var_97_5_usd") * ten_days).alias("var_10day_97_5_usd"),
        (F.col("var_99_usd") * ten_days).alias("var_10day_99_usd"),
        F.coalesce("_shortfall", "var_97_5_usd").alias("es_97_5_usd"),
        "avg_daily_return_usd", "worst_day_loss_usd", "best_day_gain_usd", "scenario_count",
    )


def desk_var(var: DataFrame, run_date: Column, *measures: str) -> DataFrame:
    """VaR measures of one day per desk, summed over asset classes."""
    return (
        var.where(F.col("calculation_date") == run_date.cast("date"))
        .groupBy("desk")
        .agg(*[F.sum(m).alias(m) for m in measures])
    )


def var_backtest(var: DataFrame, pnl: DataFrame) -> DataFrame:
    """Loss against predicted VaR per desk and day, with the rolling exception count.

    The desk's VaR is the largest over its asset classes. The window holds one desk's
    calendar of run days, which is short.
    """
    rolling = W.partitionBy("desk").orderBy("backtest_date").rowsBetween(1 - BACKTEST_ROWS, W.currentRow)
    return _judged(
        _compared(var, pnl).withColumn(
            "rolling_250d_exceptions", F.sum(F.col("is_exception").cast("int")).over(rolling).cast("int")
        )
    )


def _compared(var: DataFrame, pnl: DataFrame) -> DataFrame:
    """Loss and predicted VaR of every desk and day that has both."""
    predicted = var.groupBy(F.col("calculation_date").alias("backtest_date"), "desk").agg(
        F.max("var_97_5_usd").alias("var_97_5_usd")
    )
    lost = pnl.select(
        F.col("pnl_date").alias("backtest_date"), "desk", (-F.col("actual_pnl_usd")).alias("actual_loss_usd")
    )
    return lost.join(predicted, ["desk", "backtest_date"]).withColumn(
        "is_exception", flag(F.col("actual_loss_usd") > F.col("var_97_5_usd"))
    )


def backtest_step(window: DataFrame, var: DataFrame, pnl: DataFrame, run_date: Column) -> tuple[DataFrame, DataFrame]:
    """One day of ``var_backtest``, and the window for the next day.

    ``window`` holds each desk's newest compared days (``desk``, ``backtest_date``, ``is_exception``), none
    after the run date, and at most ``BACKTEST_ROWS`` of a desk. Of VaR and P&L only the run date is
    read. Repeating a day gives the same rows and the same window.
    """
    day = run_date.cast("date")
    today = _compared(var.where(F.col("calculation_date") == day), pnl.where(F.col("pnl_date") == day))
    past = latest_per_key(window.where(F.col("backtest_date") < day), ["desk"], ["backtest_date"], BACKTEST_ROWS - 1)
    before = past.groupBy("desk").agg(F.count_if("is_exception").alias("_before"))
    counted = today.join(before, "desk", "left").withColumn(
        "rolling_250d_exceptions", (F.coalesce("_before", F.lit(0)) + F.col("is_exception").cast("int")).cast("int")
    )
    return _judged(counted), backtest_window(past.unionByName(today.select(*past.columns)))


def backtest_window(compared: DataFrame) -> DataFrame:
    """The days of each desk that the next day's count may need."""
    return latest_per_key(compared.select("desk", "backtest_date", "is_exception"), ["desk"], ["backtest_date"], BACKTEST_ROWS)


def _judged(counted: DataFrame) -> DataFrame:
    excess = F.col("actual_loss_usd") - F.col("var_97_5_usd")
    exceptions = F.col("rolling_250d_exceptions")
    return counted.select(
        "backtest_date", "desk", "var_97_5_usd", "actual_loss_usd", "is_exception",
        F.when(F.col("is_exception"), excess).alias("exception_magnitude"),
        "rolling_250d_exceptions",
        basel_zone(exceptions).alias("basel_zone"),
        model_status(exceptions).alias("model_status"),
    )
