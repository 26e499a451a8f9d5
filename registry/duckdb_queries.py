"""The same queries as DuckDB SQL."""

from __future__ import annotations

from deskrisk.plans.statuses import STATUSES
from deskrisk.serving.charts import CHARTS, metric_name
from deskrisk.sources.schemas import KEYS, TABLES, business_columns
from registry import outputs
from registry.views import compose

SQL: dict[str, str] = {}


def _select(columns: list[str], places: dict[str, int], source: str) -> str:
    shown = [f"round({c}, {places[c]}) AS {c}" if c in places else c for c in columns]
    return f"SELECT {', '.join(shown)} FROM {source}"


# -------------------------------------------------------------------------- silver

SQL["prices_cleaned"] = (
    "SELECT price_date, open_price, high_price, low_price, close_price, volume, ticker, fetched_at FROM px"
)
SQL["positions_enriched"] = f"SELECT {', '.join(business_columns('positions_enriched'))} FROM pos"

# ---------------------------------------------------------------------------- gold

for _table in KEYS:
    SQL[_table] = _select(business_columns(_table), outputs.places(_table), _table)


def _chart_sql(name: str) -> str:
    chart = CHARTS[name]
    where = "".join(f" WHERE {c} = '{v}'" for c, v in chart.where.items())
    if chart.metrics:
        names = [metric_name(m) for m in chart.metrics]
        inner = (
            f"SELECT {', '.join(chart.columns)}, "
            + ", ".join(f"{m} AS {n}" for m, n in zip(chart.metrics, names))
            + f" FROM {chart.source}{where} GROUP BY ALL"
        )
        order = f"{names[0]} DESC NULLS LAST, {', '.join([*chart.columns, *names[1:]])}"
        shown = [*chart.columns, *names]
    else:
        inner = f"SELECT {'DISTINCT ' if chart.distinct else ''}{', '.join(chart.columns)} FROM {chart.source}{where}"
        first = [f"{c[1:]} DESC NULLS LAST" if c.startswith("-") else c for c in chart.order]
        named = {c.lstrip("-") for c in chart.order}
        order = ", ".join([*first, *[c for c in chart.columns if c not in named]])
        shown = list(chart.columns)
    limit = "" if chart.limit is None else f" LIMIT {chart.limit}"
    return _select(shown, outputs.chart_places(name), f"({inner} ORDER BY {order}{limit})")


for _name in CHARTS:
    SQL[_name] = _chart_sql(_name)

# ----------------------------------------------------------------------- ingestion

SQL["normalise_market_data"] = """
SELECT dt AS date, o AS open, h AS high, l AS low, c AS close, CASE WHEN v <> 1 THEN v END AS volume,
       symbol AS ticker, fetched_at FROM bronze_prices
"""
SQL["fx_rates_from_prices"] = """
SELECT currency, round(arg_max(close, d), 6) AS rate_vs_usd, max(d) AS as_of_date
FROM (SELECT CASE r_name WHEN 'ASIA' THEN 'JPY' WHEN 'EUROPE' THEN 'EUR' WHEN 'MIDDLE EAST' THEN 'GBP'
                  WHEN 'AMERICA' THEN 'AUD' ELSE 'SGD' END AS currency,
             CAST(o_orderdate AS DATE) AS d, max(o_totalprice) / 300000.0 AS close
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
           JOIN region ON n_regionkey = r_regionkey
      GROUP BY 1, 2)
GROUP BY currency
UNION ALL SELECT 'USD', 1.0, DATE '2001-12-31'
"""
SQL["read_landing"] = SQL["ingest_incremental"] = """
SELECT symbol AS ticker, fetched_at, count(*) AS row_count, min(dt) AS first_date, max(c) AS highest_close,
       CAST(0 AS BIGINT) AS without_file
FROM bronze_prices GROUP BY ALL
"""
SQL["ingest_evolving"] = """
SELECT symbol AS ticker, count(*) AS row_count, count(c) AS closes, count(v) FILTER (WHERE fetched_at >= '1995-07') AS volumes,
       sum(v) FILTER (WHERE fetched_at >= '1995-07') AS volume
FROM bronze_prices GROUP BY ALL
"""
SQL["landing_rejects"] = """
SELECT symbol AS ticker, count(*) FILTER (WHERE v NOT IN (1, 2)) AS loaded, count(*) FILTER (WHERE v IN (1, 2)) AS rejected
FROM bronze_prices GROUP BY ALL
"""
SQL["full_refresh"] = "SELECT trade_id, desk, notional * 3 AS notional FROM bronze_trades"
SQL["read_required"] = "SELECT desk, round(limit_usd, 2) AS limit_usd, approved_date FROM limits"
SQL["landing_inventory"] = """
SELECT DISTINCT concat('year=', fetched_at[1:4], '/month=', fetched_at[6:7], '/day=01') AS folder, 0 AS undated FROM bronze_prices
"""
_PRICE_COLUMNS = {
    "Date": ("date", "dt"), "Open": ("double", "o"), "High": ("double", "h"), "Low": ("double", "l"), "Close": ("double", "c"),
    "Volume": ("double", "v"), "ticker": ("string", "symbol"), "fetched_at": ("string", "fetched_at"),
}
_TRADE_TYPES = {"notional": "double", "trade_date": "date", "maturity_date": "date"}
_TRADE_COLUMNS = (
    "trade_id", "desk", "book_id", "trader_id", "counterparty", "asset_class", "instrument_type", "ticker", "isin", "cusip",
    "direction", "notional", "currency", "trade_date", "maturity_date", "generated_at",
)
SQL["table_schemas"] = "\nUNION ALL ".join(
    [
        f"SELECT 'market_prices' AS table_name, '{name}' AS column_name, '{kind}' AS type, count({column}) AS values FROM bronze_prices"
        for name, (kind, column) in _PRICE_COLUMNS.items()
    ]
    + [
        f"SELECT 'positions', '{name}', '{_TRADE_TYPES.get(name, 'string')}', count({name}) FROM bronze_trades"
        for name in _TRADE_COLUMNS
    ]
)
SQL["schema_guard"] = "SELECT desk, count(*) AS trades, 3 AS refused FROM pos GROUP BY desk"
SQL["noise_hash"] = "SELECT desk, count(*) AS row_count, count(*) AS within FROM bronze_trades GROUP BY desk"
SQL["prices_incremental"] = """
SELECT s.*, current_price, latest_price_date
FROM px_restated s JOIN (SELECT ticker, arg_max(close_price, price_date) AS current_price, max(price_date) AS latest_price_date
                         FROM px_restated GROUP BY ticker) USING (ticker)
"""
SQL["trades_incremental"] = """
SELECT trade_id, desk, currency, CASE WHEN trade_id[-1] IN ('0', '2', '4', '6', '8') THEN notional * 2 ELSE notional END AS notional,
       days_to_maturity FROM pos
"""
SQL["backtest_step"] = (
    _select(business_columns("var_backtest"), outputs.places("var_backtest"), "var_backtest")
    + " WHERE backtest_date = (SELECT max(backtest_date) FROM var_backtest)"
)
SQL["breach_log_step"] = _select(business_columns("limit_breach_log"), outputs.places("limit_breach_log"), "quarter_breach_log")
SQL["stop_on_fail"] = """
SELECT ticker, count(*) AS row_count, min(close_price) AS lowest_close, 1 AS refused FROM px GROUP BY ticker
"""
_HEALTHY = {"positions": "bronze_trades", "prices_cleaned": "px", "desk_limits": "limits"}
SQL["lake_health"] = "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count, CAST(NULL AS VARCHAR) AS error FROM {_HEALTHY[t]}"
    if t in _HEALTHY
    else f"SELECT '{t}', NULL, '{'FAILED_READ_FILE.NO_HINT' if t == 'var_daily' else 'MISSING'}'"
    for t in sorted(TABLES, key=lambda t: t not in _HEALTHY)
)
SQL["reload_forced"] = """
SELECT desk, round(limit_usd, 2) AS limit_usd, approved_date FROM limits
UNION ALL SELECT desk, round(limit_usd, 2), approved_date FROM limits
"""
SQL["truncate_reload"] = "SELECT trade_id, desk, notional * 2 AS notional FROM bronze_trades"
SQL["evolve_append"] = """
SELECT trade_id, desk, notional, CASE WHEN trade_date >= DATE '1998-01-01' THEN isin END AS isin FROM bronze_trades
"""
SQL["skip_landed"] = """
SELECT ticker, trade_date AS day FROM bronze_trades
EXCEPT SELECT replace(replace(symbol, '=X', ''), '.', '_'), dt FROM bronze_prices
"""
SQL["read_seed"] = "SELECT ticker, sector, nullif(geography, 'UK') AS geography FROM classes"

# -------------------------------------------------------------------------- upsert

SQL["merge_upsert"] = SQL["merge_upsert_table"] = """
SELECT desk, as_of_date,
       round(CASE WHEN as_of_date >= DATE '2000-06-01' THEN gross_exposure_usd * 2 ELSE gross_exposure_usd END, 6) AS gross_exposure_usd,
       round(CASE WHEN as_of_date >= DATE '2001-01-01' THEN limit_usd + 1 ELSE limit_usd END, 6) AS limit_usd
FROM exposure_history
"""

# ------------------------------------------------------------------------- quality


def _failures(*checks: tuple[str, str]) -> str:
    return "\nUNION ALL ".join(f"SELECT '{name}' AS check_name, ({sql}) AS failures" for name, sql in checks)


SQL["check_not_null"] = _failures(
    ("not_null_Close", "SELECT count(*) FROM bronze_prices WHERE c IS NULL"),
    ("not_null_Open", "SELECT count(*) FROM bronze_prices WHERE o IS NULL"),
    ("not_null_ticker", "SELECT count(*) FROM bronze_prices WHERE symbol IS NULL"),
)


def _repeated(columns: str, table: str) -> str:
    return f"SELECT count(*) FROM (SELECT {columns} FROM {table} GROUP BY {columns} HAVING count(*) > 1)"


SQL["check_unique"] = _failures(
    ("unique_trade_id", _repeated("trade_id", "bronze_trades")),
    ("unique_o_orderkey", _repeated("o_orderkey", "orders")),
)
SQL["check_unique_combination"] = _failures(
    ("unique_l_orderkey_l_linenumber", _repeated("l_orderkey, l_linenumber", "lineitem")),
    ("unique_ticker_price_date", _repeated("ticker, price_date", "px")),
)
_FOUR_DESKS = "('FX Desk', 'Equity Desk', 'Rates Desk', 'Credit Desk')"
_FOUR_CLASSES = "('FX', 'Equity', 'Rates', 'Credit')"
SQL["check_accepted_values"] = _failures(
    ("accepted_direction", "SELECT count(*) FROM bronze_trades WHERE direction NOT IN ('LONG', 'SHORT')"),
    ("accepted_asset_class", f"SELECT count(*) FROM bronze_trades WHERE asset_class NOT IN {_FOUR_CLASSES}"),
    ("accepted_desk", f"SELECT count(*) FROM bronze_trades WHERE desk NOT IN {_FOUR_DESKS}"),
)
SQL["column_checks"] = _failures(
    ("not_null_trade_id", "SELECT count(*) FROM bronze_trades WHERE trade_id IS NULL"),
    ("not_null_isin", "SELECT count(*) FROM bronze_trades WHERE isin IS NULL"),
    ("not_null_cusip", "SELECT count(*) FROM bronze_trades WHERE cusip IS NULL"),
    ("accepted_direction", "SELECT count(*) FROM bronze_trades WHERE direction NOT IN ('LONG', 'SHORT')"),
    ("accepted_currency", "SELECT count(*) FROM bronze_trades WHERE currency NOT IN ('USD', 'EUR')"),
)


def _gate(gate: str, table: str, counts: dict[str, str]) -> str:
    """Profile columns as expressions; the first failing count names the status."""
    profile = ", ".join(f"{sql} AS {name}" for name, sql in counts.items())
    chain = " ".join(f"WHEN {name} > 0 THEN '{status.replace(chr(39), chr(39) * 2)}'" for name, status in STATUSES[gate])
    return f"SELECT *, CASE {chain} ELSE 'PASS' END AS quality_status FROM (SELECT {profile} FROM {table})"


def _n(predicate: str) -> str:
    return f"count(*) FILTER (WHERE {predicate})"


SQL["prices_gate"] = _gate(
    "prices_gate", "px",
    {
        "total_rows": "count(*)", "unique_tickers": "count(DISTINCT ticker)",
        "unique_dates": "count(DISTINCT price_date)", "earliest_date": "min(price_date)", "latest_date": "max(price_date)",
        "null_price_date": "CAST(sum(CASE WHEN price_date IS NULL THEN 1 END) AS BIGINT)",
        "null_ticker": "CAST(sum(CASE WHEN ticker IS NULL THEN 1 END) AS BIGINT)",
        "null_close_price": "CAST(sum(CASE WHEN close_price IS NULL THEN 1 END) AS BIGINT)",
        "duplicate_rows": "count(*) - count(DISTINCT CAST(price_date AS VARCHAR) || '/' || ticker)",
        "non_positive_close_price": _n("close_price <= 0"),
    },
)
SQL["positions_gate"] = _gate(
    "positions_gate", "pos",
    {
        "total_rows": "count(*)", "unique_trades": "count(DISTINCT trade_id)", "unique_desks": "count(DISTINCT desk)",
        "unique_currencies": "count(DISTINCT currency)", "null_trade_id": _n("trade_id IS NULL"),
        "null_notional_usd": _n("notional_usd IS NULL"), "null_fx_rate": _n("fx_rate_vs_usd IS NULL"),
        "null_net_exposure": _n("net_exposure_usd IS NULL"),
        "duplicate_trade_ids": "count(*) - count(DISTINCT trade_id)",
        "non_positive_notional": _n("notional_usd <= 0"),
        "invalid_direction": _n("direction_multiplier NOT IN (1, -1)"),
        "positions_with_price": _n("current_price IS NOT NULL"),
        "positions_without_price": _n("current_price IS NULL"),
    },
)
SQL["desk_breakdown"] = """
SELECT desk, count(*) AS position_count, count(DISTINCT counterparty) AS unique_counterparties,
       count(DISTINCT asset_class) AS unique_asset_classes, round(sum(notional_usd), 2) AS total_notional_usd,
       round(sum(net_exposure_usd), 2) AS net_exposure_usd,
       count(*) FILTER (WHERE direction = 'LONG') AS long_positions,
       count(*) FILTER (WHERE direction = 'SHORT') AS short_positions
FROM pos GROUP BY desk
"""
SQL["silver_summary"] = """
SELECT 'prices_cleaned' AS table_name, count(*) AS row_count, count(DISTINCT ticker) AS unique_tickers FROM px
UNION ALL SELECT 'positions_enriched', count(*), count(DISTINCT desk) FROM pos
"""
SQL["var_gate"] = _gate(
    "var_gate", "var_daily",
    {
        "total_rows": "count(*)", "unique_desks": "count(DISTINCT desk)",
        "unique_asset_classes": "count(DISTINCT asset_class)", "unique_dates": "count(DISTINCT calculation_date)",
        "null_var_95": _n("var_95_usd IS NULL"), "null_var_97_5": _n("var_97_5_usd IS NULL"),
        "null_var_99": _n("var_99_usd IS NULL"), "null_var_10day": _n("var_10day_97_5_usd IS NULL"),
        "null_es": _n("es_97_5_usd IS NULL"), "null_notional": _n("total_notional_usd IS NULL"),
        "var_97_5_less_than_95": _n("var_97_5_usd < var_95_usd"),
        "var_99_less_than_97_5": _n("var_99_usd < var_97_5_usd"),
        "es_less_than_var": _n("es_97_5_usd < var_97_5_usd"),
        "tenday_less_than_oneday": _n("var_10day_97_5_usd < var_97_5_usd"),
        "non_positive_var_95": _n("var_95_usd <= 0"), "non_positive_es": _n("es_97_5_usd <= 0"),
        "low_scenario_count": _n("scenario_count < 200"),
    },
)
SQL["pnl_gate"] = _gate(
    "pnl_gate", "pnl_attribution",
    {
        "total_rows": "count(*)", "unique_desks": "count(DISTINCT desk)", "unique_dates": "count(DISTINCT pnl_date)",
        "null_hypothetical": _n("hypothetical_pnl_usd IS NULL"), "null_actual": _n("actual_pnl_usd IS NULL"),
        "null_unexplained": _n("unexplained_pnl_usd IS NULL"),
        "pnl_mismatch_rows": _n("abs(unexplained_pnl_usd - (actual_pnl_usd - hypothetical_pnl_usd)) > 0.01"),
    },
)
SQL["backtest_gate"] = _gate(
    "backtest_gate", "var_backtest",
    {
        "total_rows": "count(*)", "unique_desks": "count(DISTINCT desk)",
        "unique_dates": "count(DISTINCT backtest_date)", "null_var": _n("var_97_5_usd IS NULL"),
        "null_actual_loss": _n("actual_loss_usd IS NULL"),
        "null_rolling_count": _n("rolling_250d_exceptions IS NULL"), "null_basel_zone": _n("basel_zone IS NULL"),
        "magnitude_on_non_exception": _n("NOT is_exception AND exception_magnitude IS NOT NULL"),
        "missing_magnitude_on_exception": _n("is_exception AND coalesce(exception_magnitude, 0) <= 0"),
        "red_zone_mismatch": _n("basel_zone = 'RED' AND rolling_250d_exceptions < 10"),
        "amber_zone_mismatch": _n("basel_zone = 'AMBER' AND rolling_250d_exceptions NOT BETWEEN 5 AND 9"),
        "total_exceptions": _n("is_exception"), "total_non_exceptions": _n("NOT is_exception"),
        "green_rows": _n("basel_zone = 'GREEN'"), "amber_rows": _n("basel_zone = 'AMBER'"),
        "red_rows": _n("basel_zone = 'RED'"),
    },
)
SQL["exposure_gate"] = _gate(
    "exposure_gate", "exposure_monitor",
    {
        "total_rows": "count(*)", "unique_desks": "count(DISTINCT desk)",
        "null_gross_exposure": _n("gross_exposure_usd IS NULL"), "null_limit": _n("limit_usd IS NULL"),
        "null_utilisation": _n("utilisation_pct IS NULL"), "null_limit_status": _n("limit_status IS NULL"),
        "negative_gross_exposure": _n("gross_exposure_usd < 0"), "non_positive_limit": _n("limit_usd <= 0"),
        "negative_utilisation": _n("utilisation_pct < 0"),
        "red_flag_mismatch": _n("limit_status = 'RED' AND (NOT breach_flag OR warning_flag)"),
        "amber_flag_mismatch": _n("limit_status = 'AMBER' AND (NOT warning_flag OR breach_flag)"),
        "green_flag_mismatch": _n("limit_status = 'GREEN' AND (warning_flag OR breach_flag)"),
        "invalid_status_values": _n("limit_status NOT IN ('RED', 'AMBER', 'GREEN')"),
        "red_desks": _n("limit_status = 'RED'"), "amber_desks": _n("limit_status = 'AMBER'"),
        "green_desks": _n("limit_status = 'GREEN'"),
    },
)
SQL["gold_summary"] = "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count, count(DISTINCT desk) AS unique_desks, max({d}) AS latest_date FROM {t}"
    for t, d in (
        ("var_daily", "calculation_date"), ("var_backtest", "backtest_date"),
        ("pnl_attribution", "pnl_date"), ("exposure_monitor", "as_of_date"),
    )
)
SQL["bronze_load_audit"] = """
SELECT 'market_prices' AS table_name, fetched_at AS load_stamp, count(*) AS row_count FROM bronze_prices GROUP BY ALL
UNION ALL SELECT 'positions', strftime(generated_at, '%Y-%m-%d'), count(*) FROM bronze_trades GROUP BY ALL
UNION ALL SELECT 'desk_limits', CAST(approved_date AS VARCHAR), count(*) FROM limits GROUP BY ALL
"""
SQL["validate_book"] = _gate(
    "validate_book", "bronze_trades",
    {
        "total_rows": "count(*)", "duplicate_trade_ids": "count(*) - count(DISTINCT trade_id)",
        "bad_asset_class": _n(f"asset_class IS NULL OR asset_class NOT IN {_FOUR_CLASSES}"),
        "bad_direction": _n("direction IS NULL OR direction NOT IN ('LONG', 'SHORT')"),
        "bad_notional": _n("notional IS NULL OR notional <= 0"), "bad_isin": _n("length(isin) <> 12"),
        "bad_cusip": _n("length(cusip) <> 9"), "fx_with_isin": _n("asset_class = 'FX' AND isin IS NOT NULL"),
        "fx_with_cusip": _n("asset_class = 'FX' AND cusip IS NOT NULL"),
        "equity_without_isin": _n("asset_class = 'Equity' AND isin IS NULL"),
        "desk_class_mismatch": _n(f"desk IN {_FOUR_DESKS} AND asset_class IS DISTINCT FROM replace(desk, ' Desk', '')"),
    },
)
SQL["book_profile"] = """
SELECT desk, asset_class, instrument_type, count(trade_id) AS trades, count(isin) AS with_isin
FROM bronze_trades GROUP BY ALL
"""

# ------------------------------------------------------------------------- serving

_VAR_REPORT = """
SELECT desk, asset_class, round(var_95_usd, 2) AS var_95_usd, round(var_99_usd, 2) AS var_99_usd, calculation_date
FROM var_daily
"""
SQL["var_report"] = _VAR_REPORT
SQL["var_report_desk"] = _VAR_REPORT + " WHERE upper(desk) = 'MACRO DESK'"
SQL["active_breaches"] = """
SELECT desk, round(gross_exposure_usd, 2) AS gross_exposure_usd, round(limit_usd, 2) AS limit_usd, utilisation_pct,
       limit_status, breach_flag FROM exposure_monitor WHERE breach_flag
"""
SQL["pnl_summary"] = """
SELECT desk, round(actual_pnl_usd, 2) AS actual_pnl_usd, round(hypothetical_pnl_usd, 2) AS hypothetical_pnl_usd,
       round(unexplained_pnl_usd, 2) AS unexplained_pnl_usd, pnl_date FROM pnl_attribution
"""
# The tables that are given.
GIVEN_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
SQL["table_health"] = "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count, CAST(NULL AS VARCHAR) AS error FROM {t}"
    for t in GIVEN_TABLES
)
SQL["desk_filter"] = (
    _select(business_columns("exposure_monitor"), outputs.places("exposure_monitor"), "exposure_monitor")
    + " WHERE desk IN ('FX Desk', 'Rates Desk')"
)


def all_sql() -> dict[str, str]:
    return {name: compose(sql) for name, sql in SQL.items()}
