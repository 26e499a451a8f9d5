"""The daily run: bronze, silver, its gates, gold, its gates."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskrisk.operators import schema_guard, scratch_of_run, settle, together
from deskrisk.operators.checks import (
    check_unique_combination,
    column_checks,
    run_checks,
    stop_on_fail,
    write_rules,
)
from deskrisk.plans import gates
from deskrisk.plans.book import position_book
from deskrisk.plans.concentration import concentration_risk
from deskrisk.plans.exposure import breach_log_step, exposure_monitor
from deskrisk.plans.incremental import newest_closes, take_prices, take_trades
from deskrisk.plans.pnl import pnl_attribution, risk_adjusted_performance
from deskrisk.plans.sensitivity import equity_sensitivity, fx_sensitivity, rates_credit_sensitivity
from deskrisk.plans.silver import enrich
from deskrisk.plans.stress import stress_testing
from deskrisk.plans.summary import risk_summary
from deskrisk.plans.value_at_risk import backtest_step, backtest_window, var_backtest, var_daily
from deskrisk.sources.lake import Lake
from deskrisk.sources.landing import append, full_refresh, read_required, truncate_reload
from deskrisk.sources.schemas import BRONZE, DATED, KEYS, SEEDS, STATE, TABLES
from deskrisk.sources.seeds import read_seed
from deskrisk.sources.versions import replace_table
from deskrisk.streaming.ingest import ingest_evolving

# The closed domains the tables are checked against.
LIGHTS = ("GREEN", "AMBER", "RED")
DOMAINS = {
    "positions_enriched": {
        "asset_class": gates.ASSET_CLASSES,
        "instrument_type": ("FX_FORWARD", "EQUITY", "CORPORATE_BOND", "CDS"),
        "direction": gates.DIRECTIONS,
        "direction_multiplier": (1, -1),
    },
    "var_daily": {"asset_class": gates.ASSET_CLASSES},
    "var_backtest": {"basel_zone": LIGHTS, "model_status": ("ACCEPTED", "REVIEW", "REJECTED")},
    "exposure_monitor": {"limit_status": LIGHTS},
    "rates_credit_sensitivity": {
        "asset_class": ("Rates", "Credit"), "tenor_bucket": ("0-1Y", "1-5Y", "5-10Y", "10Y+")
    },
    "stress_testing": {"scenario_type": ("REGULATORY", "MANAGEMENT")},
    "concentration_risk": {
        "concentration_type": (
            "COUNTERPARTY", "INSTRUMENT", "SECTOR", "GEOGRAPHY", "ASSET_CLASS", "MATURITY_BUCKET"
        ),
        "concentration_level": ("HIGH", "MEDIUM", "LOW"),
        "desk_concentration_level": ("HIGH", "MEDIUM", "LOW"),
    },
    "risk_summary": {"limit_status": LIGHTS, "basel_zone": LIGHTS, "overall_risk_status": LIGHTS},
    "risk_adjusted_performance": {"performance_flag": ("STRONG", "ADEQUATE", "LOSS")},
}
SILVER_KEYS = {"prices_cleaned": ("ticker", "price_date"), "positions_enriched": ("trade_id",)}


def _domains(table: str, desks: tuple[str, ...]) -> tuple[list[str], dict]:
    """Declared NOT NULL columns and closed domains of a table."""
    accepted = dict(DOMAINS.get(table, {}))
    if "desk" in TABLES[table].names:
        accepted["desk"] = desks
    return [f.name for f in TABLES[table] if not f.nullable], accepted


def table_rules(table: str, df: DataFrame, desks: tuple[str, ...]) -> dict[str, Column]:
    """The same, to be counted while the table is written. Columns the write adds are not NULL."""
    not_null, accepted = _domains(table, desks)
    return write_rules(df, [c for c in not_null if c in df.columns], accepted)


def table_checks(lake: Lake, table: str, desks: tuple[str, ...]):
    """The same for a stored table, and its key: for audits, as a run does not need it."""
    df = lake.read(table)
    return run_checks(
        [
            column_checks(df, *_domains(table, desks)),
            check_unique_combination(df, KEYS.get(table) or SILVER_KEYS[table]),
        ]
    )


def load_bronze(lake: Lake, landing_root: str, progress_root: str) -> None:
    """Landing zone to bronze, each table in its own way.

    Prices and positions take only files not loaded before, each by its own header; what does not
    fit is among the table's rejects. Rates are appended again on every run. Limits and seeds are
    small and replaced as a whole; a limit file without rows is an error.
    """
    spark, root = lake.spark, landing_root.rstrip("/")

    def incremental(table: str, folder: str) -> None:
        ingest_evolving(spark, f"{root}/{folder}", BRONZE[table], lake.path(table), f"{progress_root.rstrip('/')}/{table}")

    rates, limits = (f"{root}/reference/{name}.csv" for name in ("fx_rates", "desk_limits"))
    together(
        {
            "market_prices": lambda: incremental("market_prices", "prices"),
            "positions": lambda: incremental("positions", "positions"),
            "fx_rates": lambda: append(read_required(spark, rates, BRONZE["fx_rates"]), lake.path("fx_rates")),
            "desk_limits": lambda: truncate_reload(
                read_required(spark, limits, BRONZE["desk_limits"]), lake.path("desk_limits")
            ),
            **{
                name: lambda name=name: full_refresh(
                    read_seed(spark, f"{root}/seeds/{name}.csv", name), lake.path(name)
                )
                for name in SEEDS
            },
        }
    )


def build_silver(lake: Lake, as_of: date, desks: tuple[str, ...] = tuple(gates.DESK_CLASS)) -> None:
    """New loads into prices and trades, then the trades in today's rates and prices.

    What the gates forbid is counted while the rows are written, and a count above zero leaves the
    table as it was. Keys are unique as both merges and the reduction to one row per key make them.
    """
    take_prices(lake)
    take_trades(lake)
    trades = lake.read("trades_latest")
    enriched = enrich(trades, lake.read("fx_rates"), newest_closes(lake.read("month_closes")), F.lit(as_of))
    rules = table_rules("positions_enriched", enriched, desks) | write_rules(
        enriched, non_positive_notional=F.col("notional_usd") <= 0
    )
    lake.replace("positions_enriched", enriched, rules)


def check_silver(lake: Lake, desks: tuple[str, ...]) -> None:
    """Whole silver against its gates, for audits: a run has counted the same while it wrote."""
    stop_on_fail(gates.prices_gate(lake.read("prices_cleaned")), "prices_cleaned")
    stop_on_fail(gates.positions_gate(lake.read("positions_enriched")), "positions_enriched")
    for table in SILVER_KEYS:
        stop_on_fail(table_checks(lake, table, desks), table)


def backtest(lake: Lake, run_date: date) -> DataFrame:
    """The backtest of the run date, from the stored window of each desk; the window moves on with it.

    A day before the newest one of the window changes the counts of the days after it, which are then
    computed again from all of VaR and P&L.
    """
    day = F.lit(run_date)
    var, pnl, window = lake.read("var_daily"), lake.read("pnl_attribution"), lake.read("backtest_window")
    if window.where(F.col("backtest_date") > day).isEmpty():
        rows, window = backtest_step(window, var, pnl, day)
    else:
        rows = settle(var_backtest(var, pnl), "backtest")
        window, rows = backtest_window(rows), rows.where(F.col("backtest_date") >= day)
    replace_table(schema_guard(window, STATE["backtest_window"]), lake.path("backtest_window"))
    return rows


def build_gold(lake: Lake, run_date: date, desks: tuple[str, ...] = tuple(gates.DESK_CLASS)) -> None:
    """Three waves; each merges its tables before the next one reads them.

    The trades are read twice in all: once for the book, once for concentration, which
    also groups by counterparty. Of the prices, the months of the look-back are read.
    """
    day = F.lit(run_date)
    read = lake.read
    prices, months = lake.prices(), read("month_closes")
    book = settle(position_book(read("positions_enriched")), "book")
    waves: list[dict[str, Callable]] = [
        {
            "var_daily": lambda: var_daily(book, prices, day, months=months),
            "pnl_attribution": lambda: pnl_attribution(book, prices, day, months=months),
            "exposure_monitor": lambda: exposure_monitor(book, read("desk_limits"), day),
            "fx_sensitivity": lambda: fx_sensitivity(book, day),
            "equity_sensitivity": lambda: equity_sensitivity(
                book, read("ticker_classifications"), day
            ),
            "rates_credit_sensitivity": lambda: rates_credit_sensitivity(book, day),
            "concentration_risk": lambda: concentration_risk(
                read("positions_enriched"), read("ticker_classifications"), day
            ),
        },
        {
            "var_backtest": lambda: backtest(lake, run_date),
            "stress_testing": lambda: stress_testing(
                book, read("stress_scenarios"), read("var_daily"), read("desk_limits"), day
            ),
            "limit_breach_log": lambda: breach_log_step(
                lake.find("limit_breach_log"), read("exposure_monitor"), day
            ),
            "risk_adjusted_performance": lambda: risk_adjusted_performance(
                read("pnl_attribution"), read("var_daily"), read("exposure_monitor"), day
            ),
        },
        {
            "risk_summary": lambda: risk_summary(
                read("var_daily"), read("exposure_monitor"), read("pnl_attribution"), read("var_backtest"),
                read("stress_testing"), read("concentration_risk"), day,
            ),
        },
    ]
    for wave in waves:
        together({t: lambda t=t, m=m: _merge(lake, t, m(), desks) for t, m in wave.items()})


def _merge(lake: Lake, table: str, df: DataFrame, desks: tuple[str, ...]) -> None:
    lake.merge(table, df, table_rules(table, df, desks))


GOLD_GATES = {
    "var_daily": gates.var_gate, "pnl_attribution": gates.pnl_gate,
    "var_backtest": gates.backtest_gate, "exposure_monitor": gates.exposure_gate,
}


def check_gold(lake: Lake, run_date: date) -> None:
    """The gates over the run date and what was written after it; NOT NULL and domains were counted in the merges."""
    def check(table: str) -> None:
        rows = lake.read(table).where(F.col(DATED[table]) >= F.lit(run_date))  # a filter on its partitions
        stop_on_fail(GOLD_GATES[table](rows), table)

    together({table: lambda table=table: check(table) for table in GOLD_GATES})


def audit_gold(lake: Lake, desks: tuple[str, ...]) -> None:
    """All history of all gold tables against gates, domains and keys."""
    for table, gate in GOLD_GATES.items():
        stop_on_fail(gate(lake.read(table)), table)
    for table in KEYS:
        stop_on_fail(table_checks(lake, table, desks), table)


def run(lake: Lake, run_date: date, as_of: date | None = None, desks: tuple[str, ...] = tuple(gates.DESK_CLASS)) -> None:
    """One day, from bronze to checked gold. Raises at the first failing gate, before
    anything after it is written; repeating a day gives the same tables. Run one day at
    a time on a lake. The run removes the scratch tables it wrote, and no others."""
    with scratch_of_run(lake.spark):
        build_silver(lake, as_of or run_date, desks)
        build_gold(lake, run_date, desks)
    check_gold(lake, run_date)
