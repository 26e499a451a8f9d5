"""Common table expressions, in dependency order."""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {}

# ---------------------------------------------------------------- sample as bronze

VIEWS["bronze_prices"] = """
SELECT CAST(l_shipdate AS DATE) AS dt,
       l_extendedprice / l_quantity AS o,
       l_extendedprice / l_quantity * (1 + l_tax) AS h,
       l_extendedprice / l_quantity * (1 - l_discount) AS l,
       CASE WHEN l_quantity = 1 THEN NULL ELSE l_extendedprice / l_quantity END AS c,
       l_quantity AS v,
       concat('B', substr(p_brand, 7),
              CASE CAST(substr(p_brand, 7) AS INT) % 3 WHEN 0 THEN '=X' WHEN 1 THEN '.L' ELSE '' END) AS symbol,
       strftime(l_shipdate, '%Y-%m') AS fetched_at,
       l_orderkey AS s1, l_linenumber AS s2, l_extendedprice AS s3, l_partkey AS s4, l_suppkey AS s5
FROM lineitem JOIN part ON l_partkey = p_partkey
"""

VIEWS["bronze_trades"] = """
SELECT t.*,
       CASE WHEN asset_class <> 'FX' THEN substr(upper(md5(trade_id)), 1, 12) END AS isin,
       CASE WHEN asset_class = 'Equity' THEN substr(upper(md5(trade_id)), 13, 9) END AS cusip,
       CASE asset_class WHEN 'FX' THEN 'FX_FORWARD' WHEN 'Equity' THEN 'EQUITY'
            WHEN 'Rates' THEN 'CORPORATE_BOND' ELSE 'CDS' END AS instrument_type
FROM (SELECT concat('T-', lpad(CAST(l_orderkey AS VARCHAR), CAST(greatest(8, length(CAST(l_orderkey AS VARCHAR))) AS INT), '0')) AS trade_id,
             CASE c_mktsegment WHEN 'BUILDING' THEN 'FX Desk' WHEN 'MACHINERY' THEN 'Equity Desk'
                  WHEN 'AUTOMOBILE' THEN 'Rates Desk' WHEN 'HOUSEHOLD' THEN 'Credit Desk'
                  ELSE 'Macro Desk' END AS desk,
             CASE c_mktsegment WHEN 'BUILDING' THEN 'FX' WHEN 'MACHINERY' THEN 'Equity'
                  WHEN 'AUTOMOBILE' THEN 'Rates' WHEN 'HOUSEHOLD' THEN 'Credit'
                  ELSE (CASE l_orderkey % 4 WHEN 0 THEN 'FX' WHEN 1 THEN 'Equity'
                        WHEN 2 THEN 'Rates' ELSE 'Credit' END) END AS asset_class,
             concat('BOOK-', substr(o_orderpriority, 1, 1)) AS book_id,
             concat('T-', CAST(o_custkey % 5 AS VARCHAR)) AS trader_id,
             n_name AS counterparty,
             concat('B', substr(p_brand, 7),
                    CASE CAST(substr(p_brand, 7) AS INT) % 3 WHEN 1 THEN '_L' ELSE '' END) AS ticker,
             CASE o_orderstatus WHEN 'F' THEN 'LONG' WHEN 'O' THEN 'SHORT' ELSE 'FLAT' END AS direction,
             l_extendedprice AS notional,
             CASE r_name WHEN 'ASIA' THEN 'JPY' WHEN 'EUROPE' THEN 'EUR' WHEN 'MIDDLE EAST' THEN 'GBP'
                  WHEN 'AMERICA' THEN 'AUD' ELSE 'USD' END AS currency,
             CAST(o_orderdate AS DATE) AS trade_date,
             CAST(l_shipdate AS DATE) + p_size * 120 AS maturity_date,
             l_shipdate AS generated_at,
             l_linenumber AS s2, l_extendedprice AS s3, l_partkey AS s4, l_suppkey AS s5
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey
           JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
           JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey) t
"""

VIEWS["rates"] = """
SELECT currency, CAST(rate AS DOUBLE) AS rate
FROM (VALUES ('USD', 1.0), ('EUR', 1.1), ('GBP', 1.25), ('JPY', 0.0067), ('AUD', 0.65)) t(currency, rate)
"""

VIEWS["limits"] = """
SELECT desk, CAST(frac AS DOUBLE) * total AS limit_usd, CAST(approved AS DATE) AS approved_date
FROM (VALUES ('FX Desk', 0.028, '2001-01-01'), ('FX Desk', 0.5, '1999-01-01'),
             ('Equity Desk', 0.043, '2001-01-01'), ('Equity Desk', 0.01, '1999-01-01'),
             ('Rates Desk', 0.080, '2001-01-01'), ('Credit Desk', 0.042, '2001-01-01'),
             ('Macro Desk', 0.025, '2001-01-01')) t(desk, frac, approved)
     CROSS JOIN (SELECT SUM(l_extendedprice) AS total FROM lineitem) x
"""

VIEWS["limit_now"] = """
SELECT desk, max_by(limit_usd, approved_date) AS limit_usd FROM limits GROUP BY desk
"""

VIEWS["classes"] = """
SELECT DISTINCT concat('B', substr(p_brand, 7), CASE WHEN CAST(substr(p_brand, 7) AS INT) % 3 = 1 THEN '_L' ELSE '' END) AS ticker,
       CASE CAST(substr(p_brand, 7) AS INT) % 4 WHEN 0 THEN 'Technology' WHEN 1 THEN 'Financials'
            WHEN 2 THEN 'Energy' ELSE 'Health' END AS sector,
       CASE CAST(substr(p_brand, 7) AS INT) % 3 WHEN 0 THEN 'Asia' WHEN 1 THEN 'UK' ELSE 'US' END AS geography
FROM part WHERE CAST(substr(p_brand, 7) AS INT) <= 22
"""

VIEWS["shocks"] = """
SELECT name AS scenario_name, asset_class, CAST(pct AS DOUBLE) AS pct, CAST(bps AS DOUBLE) AS bps, kind, proxy
FROM (VALUES ('Crash', 'Equity', -0.35, NULL, 'REGULATORY', TRUE), ('Crash', 'FX', -0.12, NULL, 'REGULATORY', TRUE),
             ('Crash', 'Rates', NULL, 250.0, 'REGULATORY', TRUE), ('Crash', 'Credit', NULL, 450.0, 'REGULATORY', TRUE),
             ('Rates Up', 'Rates', NULL, 200.0, 'REGULATORY', FALSE), ('Rates Up', 'Credit', NULL, 50.0, 'REGULATORY', FALSE),
             ('Equity Only', 'Equity', -0.25, NULL, 'MANAGEMENT', FALSE)) t(name, asset_class, pct, bps, kind, proxy)
"""

# ------------------------------------------------------------------------- silver

VIEWS["px"] = """
SELECT dt AS price_date, o AS open_price, h AS high_price, l AS low_price, c AS close_price, v AS volume,
       replace(regexp_replace(symbol, '=X$', ''), '.', '_') AS ticker, fetched_at
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY symbol, dt
             ORDER BY s1 DESC, s2 DESC, s3 DESC, s4 DESC, s5 DESC, v DESC) AS rn
      FROM bronze_prices WHERE c IS NOT NULL)
WHERE rn = 1
"""

# Two loads: up to 1997 at twice the price, then from mid-1996 on as it is.
VIEWS["px_restated"] = """
SELECT price_date, ticker, volume,
       CASE WHEN price_date < DATE '1996-06-10' THEN close_price * 2 ELSE close_price END AS close_price
FROM px
"""

VIEWS["px_last"] = """
SELECT ticker, max(price_date) AS latest_price_date, arg_max(close_price, price_date) AS current_price
FROM px GROUP BY ticker
"""

VIEWS["pos"] = """
SELECT b.trade_id, desk, book_id, trader_id, counterparty, asset_class, instrument_type, b.ticker, isin, cusip,
       direction, notional, b.currency, trade_date, maturity_date, rate AS fx_rate_vs_usd,
       notional * rate AS notional_usd, current_price, latest_price_date,
       coalesce(current_price, notional) * rate AS market_value_usd,
       CAST(datediff('day', DATE '2001-12-31', maturity_date) AS INTEGER) AS days_to_maturity,
       CASE direction WHEN 'LONG' THEN 1 WHEN 'SHORT' THEN -1 ELSE 0 END AS direction_multiplier,
       notional * rate * CASE direction WHEN 'LONG' THEN 1 WHEN 'SHORT' THEN -1 ELSE 0 END AS net_exposure_usd
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY trade_id
             ORDER BY generated_at DESC, s2 DESC, s3 DESC, s4 DESC, s5 DESC) AS rn FROM bronze_trades) b
     JOIN rates r ON r.currency = b.currency
     LEFT JOIN px_last p ON p.ticker = b.ticker
WHERE rn = 1
"""

# --------------------------------------------------------------------------- gold

VIEWS["ret"] = """
SELECT ticker, price_date, (close_price - prev) / prev AS r
FROM (SELECT ticker, price_date, close_price,
             LAG(close_price) OVER (PARTITION BY ticker ORDER BY price_date) AS prev FROM px)
WHERE prev > 0
"""

VIEWS["scen"] = """
SELECT desk, asset_class, price_date, SUM(notional_usd * r * direction_multiplier) AS pl,
       COUNT(DISTINCT trade_id) AS trades, SUM(notional_usd) AS notional
FROM pos JOIN ret USING (ticker)
WHERE price_date >= (SELECT max(price_date) - 365 FROM px)
GROUP BY ALL
"""

VIEWS["var_daily"] = """
SELECT DATE '2001-12-31' AS calculation_date, q.desk, q.asset_class,
       CAST(max(trades) AS INTEGER) AS position_count, max(notional) AS total_notional_usd,
       any_value(v95) AS var_95_usd, any_value(v975) AS var_97_5_usd, any_value(v99) AS var_99_usd,
       any_value(v95) * sqrt(10) AS var_10day_95_usd, any_value(v975) * sqrt(10) AS var_10day_97_5_usd,
       any_value(v99) * sqrt(10) AS var_10day_99_usd,
       coalesce(abs(avg(pl) FILTER (WHERE pl < -v975)), any_value(v975)) AS es_97_5_usd,
       avg(pl) AS avg_daily_return_usd, min(pl) AS worst_day_loss_usd, max(pl) AS best_day_gain_usd,
       CAST(count(*) AS INTEGER) AS scenario_count
FROM scen s JOIN (SELECT desk, asset_class, abs(quantile_cont(pl, 0.05)) AS v95,
                         abs(quantile_cont(pl, 0.025)) AS v975, abs(quantile_cont(pl, 0.01)) AS v99
                  FROM scen GROUP BY ALL) q ON s.desk = q.desk AND s.asset_class = q.asset_class
GROUP BY q.desk, q.asset_class
"""

VIEWS["desk_var"] = """
SELECT desk, SUM(total_notional_usd) AS total_notional_usd, SUM(var_99_usd) AS var_99_usd,
       SUM(var_10day_97_5_usd) AS var_10day_97_5_usd, SUM(es_97_5_usd) AS es_97_5_usd
FROM var_daily GROUP BY desk
"""

VIEWS["moves"] = """
SELECT ticker, (a.close_price - b.close_price) / nullif(b.close_price, 0) AS r
FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY price_date DESC) AS k
      FROM px WHERE price_date <= DATE '2001-12-31') a
     LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY price_date DESC) AS k
                FROM px WHERE price_date <= DATE '2001-12-31') b USING (ticker)
WHERE a.k = 1 AND b.k = 2
"""

VIEWS["trade_pnl"] = """
SELECT desk, trade_id, direction, notional_usd * coalesce(r, 0) * direction_multiplier AS hypo,
       1 + (CAST(('0x' || substr(md5(trade_id), 1, 8)) AS BIGINT) % 100) / 10000.0 AS noise
FROM pos JOIN (SELECT ticker, r FROM (SELECT DISTINCT ticker FROM px) LEFT JOIN moves USING (ticker)) USING (ticker)
"""

VIEWS["pnl_attribution"] = """
SELECT DATE '2001-12-31' AS pnl_date, desk, SUM(hypo) AS hypothetical_pnl_usd, SUM(hypo * noise) AS actual_pnl_usd,
       SUM(hypo * noise) - SUM(hypo) AS unexplained_pnl_usd,
       CAST(COUNT(DISTINCT trade_id) AS INTEGER) AS position_count,
       coalesce(SUM(hypo * noise) FILTER (WHERE direction = 'LONG'), 0) AS long_pnl_usd,
       coalesce(SUM(hypo * noise) FILTER (WHERE direction = 'SHORT'), 0) AS short_pnl_usd
FROM trade_pnl GROUP BY desk
"""

VIEWS["pnl_history"] = """
SELECT desk, price_date AS pnl_date, SUM(notional_usd * r * direction_multiplier) AS actual_pnl_usd
FROM pos JOIN ret USING (ticker) GROUP BY ALL
"""


def _backtest(pnl: str) -> str:
    return f"""
SELECT *, CASE WHEN n >= 10 THEN 'RED' WHEN n >= 5 THEN 'AMBER' ELSE 'GREEN' END AS basel_zone,
       CASE WHEN n >= 10 THEN 'REJECTED' WHEN n >= 5 THEN 'REVIEW' ELSE 'ACCEPTED' END AS model_status
FROM (SELECT pnl_date AS backtest_date, desk, var_97_5_usd, -actual_pnl_usd AS actual_loss_usd,
             -actual_pnl_usd > var_97_5_usd AS is_exception,
             CASE WHEN -actual_pnl_usd > var_97_5_usd THEN -actual_pnl_usd - var_97_5_usd END AS exception_magnitude,
             CAST(COUNT(*) FILTER (WHERE -actual_pnl_usd > var_97_5_usd) OVER (
                  PARTITION BY desk ORDER BY pnl_date ROWS BETWEEN 249 PRECEDING AND CURRENT ROW) AS INTEGER) AS n
      FROM {pnl} JOIN (SELECT desk, MAX(var_97_5_usd) AS var_97_5_usd FROM var_daily GROUP BY desk) USING (desk))
"""


VIEWS["var_backtest"] = "SELECT * RENAME (n AS rolling_250d_exceptions) FROM (" + _backtest("pnl_history") + ")"

VIEWS["pnl_all"] = """
SELECT desk, pnl_date, actual_pnl_usd FROM pnl_history
UNION ALL SELECT desk, pnl_date, actual_pnl_usd FROM pnl_attribution
"""

VIEWS["backtest_run"] = "SELECT * RENAME (n AS rolling_250d_exceptions) FROM (" + _backtest("pnl_all") + ")"

VIEWS["exposure_monitor"] = """
SELECT DATE '2001-12-31' AS as_of_date, *,
       CASE WHEN utilisation_pct >= 100 THEN 'RED' WHEN utilisation_pct >= 80 THEN 'AMBER' ELSE 'GREEN' END AS limit_status,
       utilisation_pct >= 80 AND utilisation_pct < 100 AS warning_flag,
       utilisation_pct >= 100 AS breach_flag
FROM (SELECT p.desk, gross_exposure_usd, net_exposure_usd, long_exposure_usd, short_exposure_usd, position_count,
             limit_usd, round(gross_exposure_usd / limit_usd * 100, 4) AS utilisation_pct
      FROM (SELECT desk, SUM(abs(notional_usd)) AS gross_exposure_usd, SUM(net_exposure_usd) AS net_exposure_usd,
                   SUM(CASE WHEN direction = 'LONG' THEN notional_usd ELSE 0 END) AS long_exposure_usd,
                   SUM(CASE WHEN direction = 'SHORT' THEN notional_usd ELSE 0 END) AS short_exposure_usd,
                   CAST(COUNT(DISTINCT trade_id) AS INTEGER) AS position_count
            FROM pos GROUP BY desk) p JOIN limit_now l ON upper(l.desk) = upper(p.desk))
"""

VIEWS["fx_sensitivity"] = """
SELECT DATE '2001-12-31' AS calculation_date, *, greatest(long_notional_usd, abs(short_notional_usd)) AS net_open_position_usd,
       abs(net_notional_usd) * 0.01 AS fx_delta_1pct_usd, net_notional_usd * 0.01 AS fx_delta_up_1pct_usd,
       net_notional_usd * -0.01 AS fx_delta_down_1pct_usd
FROM (SELECT desk, currency, asset_class, CAST(COUNT(DISTINCT trade_id) AS INTEGER) AS position_count,
             CAST(COUNT(DISTINCT trade_id) FILTER (WHERE direction = 'LONG') AS INTEGER) AS long_position_count,
             CAST(COUNT(DISTINCT trade_id) FILTER (WHERE direction = 'SHORT') AS INTEGER) AS short_position_count,
             SUM(abs(notional_usd)) AS gross_notional_usd,
             SUM(CASE WHEN direction_multiplier = 1 THEN notional_usd ELSE 0 END) AS long_notional_usd,
             SUM(CASE WHEN direction_multiplier = -1 THEN notional_usd ELSE 0 END) AS short_notional_usd,
             SUM(notional_usd * direction_multiplier) AS net_notional_usd, MAX(fx_rate_vs_usd) AS fx_rate_vs_usd
      FROM pos WHERE currency <> 'USD' GROUP BY ALL)
"""

VIEWS["equity_sensitivity"] = """
SELECT DATE '2001-12-31' AS calculation_date, e.desk, e.ticker, coalesce(sector, 'Unknown') AS sector,
       coalesce(geography, 'Unknown') AS geography, position_count, long_position_count, short_position_count,
       gross_notional_usd, net_notional_usd, current_price, latest_price_date,
       abs(net_notional_usd) * 0.01 AS equity_delta_1pct_usd, net_notional_usd * 0.01 AS equity_delta_up_1pct_usd,
       net_notional_usd * -0.01 AS equity_delta_down_1pct_usd,
       long_side * 0.01 AS long_delta_usd, abs(short_side) * 0.01 AS short_delta_usd
FROM (SELECT desk, ticker, CAST(COUNT(DISTINCT trade_id) AS INTEGER) AS position_count,
             CAST(COUNT(DISTINCT trade_id) FILTER (WHERE direction = 'LONG') AS INTEGER) AS long_position_count,
             CAST(COUNT(DISTINCT trade_id) FILTER (WHERE direction = 'SHORT') AS INTEGER) AS short_position_count,
             SUM(abs(notional_usd)) AS gross_notional_usd,
             SUM(CASE WHEN direction = 'LONG' THEN notional_usd ELSE 0 END) AS long_side,
             SUM(CASE WHEN direction = 'SHORT' THEN notional_usd ELSE 0 END) AS short_side,
             SUM(notional_usd * direction_multiplier) AS net_notional_usd,
             MAX(current_price) AS current_price, MAX(latest_price_date) AS latest_price_date
      FROM pos WHERE asset_class = 'Equity' GROUP BY ALL) e
     LEFT JOIN classes c ON upper(c.ticker) = upper(e.ticker)
"""

VIEWS["matured"] = """
SELECT desk, asset_class, currency, CAST(COUNT(DISTINCT trade_id) AS INTEGER) AS n
FROM pos WHERE asset_class IN ('Rates', 'Credit') AND coalesce(days_to_maturity, 0) <= 0 GROUP BY ALL
"""

VIEWS["rates_credit_sensitivity"] = """
SELECT DATE '2001-12-31' AS calculation_date, g.desk, g.asset_class, tenor_bucket, g.currency AS rate_currency,
       position_count, coalesce(m.n, 0) AS matured_position_count, gross_notional_usd, net_notional_usd,
       w / nullif(gross_notional_usd, 0) AS weighted_avg_duration_years,
       CASE WHEN g.asset_class = 'Rates' THEN abs(s) ELSE 0 END AS pv01_usd,
       CASE WHEN g.asset_class = 'Rates' THEN -s ELSE 0 END AS pv01_up_1bp_usd,
       CASE WHEN g.asset_class = 'Rates' THEN s ELSE 0 END AS pv01_down_1bp_usd,
       CASE WHEN g.asset_class = 'Rates' THEN abs(s) * 100 ELSE 0 END AS dv01_100bps_usd,
       CASE WHEN g.asset_class = 'Credit' THEN abs(s) ELSE 0 END AS cs01_usd,
       CASE WHEN g.asset_class = 'Credit' THEN -s ELSE 0 END AS cs01_widen_1bp_usd,
       CASE WHEN g.asset_class = 'Credit' THEN s ELSE 0 END AS cs01_tighten_1bp_usd,
       CASE WHEN g.asset_class = 'Credit' THEN abs(s) * 100 ELSE 0 END AS cs01_100bps_usd
FROM (SELECT desk, asset_class, currency,
             CASE WHEN days_to_maturity <= 365 THEN '0-1Y' WHEN days_to_maturity <= 1825 THEN '1-5Y'
                  WHEN days_to_maturity <= 3650 THEN '5-10Y' ELSE '10Y+' END AS tenor_bucket,
             CAST(COUNT(DISTINCT trade_id) AS INTEGER) AS position_count, SUM(abs(notional_usd)) AS gross_notional_usd,
             SUM(notional_usd * direction_multiplier) AS net_notional_usd,
             SUM(abs(notional_usd) * (CAST(days_to_maturity AS DOUBLE) / 365.0)) AS w,
             SUM(notional_usd * direction_multiplier * (CAST(days_to_maturity AS DOUBLE) / 365.0) * 0.0001) AS s
      FROM pos WHERE asset_class IN ('Rates', 'Credit') AND days_to_maturity > 0 GROUP BY ALL) g
     LEFT JOIN matured m ON m.desk = g.desk AND m.asset_class = g.asset_class AND m.currency = g.currency
"""

VIEWS["trade_stress"] = """
SELECT desk, p.asset_class, trade_id, notional_usd, scenario_name, kind, proxy,
       CASE WHEN pct IS NOT NULL THEN notional_usd * pct * direction_multiplier
            WHEN bps IS NOT NULL THEN -notional_usd * greatest(CAST(coalesce(days_to_maturity, 0) AS DOUBLE) / 365.0, 0)
                                      * bps * 0.0001 * direction_multiplier
            ELSE 0 END AS pl
FROM pos p JOIN shocks s ON upper(s.asset_class) = upper(p.asset_class)
"""

VIEWS["stress_testing"] = """
SELECT DATE '2001-12-31' AS calculation_date, t.desk, t.scenario_name, scenario_type, is_stressed_var_proxy, position_count,
       t.total_notional_usd, portfolio_total_notional_usd,
       round(t.total_notional_usd / nullif(portfolio_total_notional_usd, 0) * 100, 4) AS coverage_pct,
       stressed_pnl_usd, stressed_pnl_equity_usd, stressed_pnl_fx_usd, stressed_pnl_rates_usd, stressed_pnl_credit_usd,
       worst_asset_class, worst_asset_class_pnl_usd, v.var_99_usd,
       CASE WHEN v.var_99_usd > 0 THEN round(abs(stressed_pnl_usd) / v.var_99_usd, 4) END AS stressed_loss_to_var_ratio,
       l.limit_usd AS desk_limit_usd,
       CASE WHEN l.limit_usd > 0 THEN round(abs(stressed_pnl_usd) / l.limit_usd * 100, 4) END AS stressed_loss_to_limit_pct
FROM (SELECT desk, scenario_name, max(kind) AS scenario_type, bool_or(proxy) AS is_stressed_var_proxy,
             CAST(COUNT(DISTINCT trade_id) AS INTEGER) AS position_count, SUM(abs(notional_usd)) AS total_notional_usd,
             SUM(pl) AS stressed_pnl_usd,
             SUM(CASE WHEN asset_class = 'Equity' THEN pl ELSE 0 END) AS stressed_pnl_equity_usd,
             SUM(CASE WHEN asset_class = 'FX' THEN pl ELSE 0 END) AS stressed_pnl_fx_usd,
             SUM(CASE WHEN asset_class = 'Rates' THEN pl ELSE 0 END) AS stressed_pnl_rates_usd,
             SUM(CASE WHEN asset_class = 'Credit' THEN pl ELSE 0 END) AS stressed_pnl_credit_usd
      FROM trade_stress GROUP BY ALL) t
     CROSS JOIN (SELECT SUM(abs(notional_usd)) AS portfolio_total_notional_usd FROM pos)
     JOIN (SELECT desk, scenario_name, arg_min(asset_class, pl) AS worst_asset_class, min(pl) AS worst_asset_class_pnl_usd
           FROM (SELECT desk, scenario_name, asset_class, SUM(pl) AS pl FROM trade_stress GROUP BY ALL)
           GROUP BY ALL) w ON w.desk = t.desk AND w.scenario_name = t.scenario_name
     LEFT JOIN desk_var v ON v.desk = t.desk
     LEFT JOIN limit_now l ON upper(l.desk) = upper(t.desk)
"""

VIEWS["sides"] = """
SELECT p.*, coalesce(sector, 'Unknown') AS sector, coalesce(geography, 'Unknown') AS geography,
       CASE WHEN coalesce(days_to_maturity, 0) <= 365 THEN '0-1Y' WHEN days_to_maturity <= 1825 THEN '1-5Y'
            WHEN days_to_maturity <= 3650 THEN '5-10Y' ELSE '10Y+' END AS maturity_bucket
FROM pos p LEFT JOIN classes c ON upper(c.ticker) = upper(p.ticker)
"""

def _exact(amount: str) -> str:
    """A sum in whole units and millionths, which no order of addition changes."""
    return f"(SUM(floor({amount})) + SUM(round(({amount} - floor({amount})) * 1000000)) / 1000000.0)"


VIEWS["entities"] = "\nUNION ALL ".join(
    f"SELECT desk, '{kind}' AS concentration_type, {column} AS entity_name, "
    f"CAST(COUNT(DISTINCT trade_id) AS INTEGER) AS position_count, {_exact('abs(notional_usd)')} AS gross_exposure_usd, "
    f"{_exact('net_exposure_usd')} AS net_exposure_usd FROM sides GROUP BY ALL"
    for kind, column in (
        ("COUNTERPARTY", "counterparty"), ("INSTRUMENT", "ticker"), ("SECTOR", "sector"),
        ("GEOGRAPHY", "geography"), ("ASSET_CLASS", "asset_class"), ("MATURITY_BUCKET", "maturity_bucket"),
    )
)

VIEWS["concentration_risk"] = """
SELECT DATE '2001-12-31' AS as_of_date, *, abs(net_exposure_usd) AS net_abs_exposure_usd,
       CASE WHEN pct_of_portfolio_total > 10 THEN 'HIGH' WHEN pct_of_portfolio_total > 5 THEN 'MEDIUM' ELSE 'LOW' END AS concentration_level,
       CASE WHEN pct_of_desk_total > 20 THEN 'HIGH' WHEN pct_of_desk_total > 10 THEN 'MEDIUM' ELSE 'LOW' END AS desk_concentration_level,
       CAST(row_number() OVER (PARTITION BY desk, concentration_type ORDER BY gross_exposure_usd DESC, entity_name) AS INTEGER) AS desk_rank,
       CAST(row_number() OVER (PARTITION BY concentration_type ORDER BY gross_exposure_usd DESC, desk, entity_name) AS INTEGER) AS portfolio_rank,
       round(SUM(power(pct_of_desk_total, 2)) OVER (PARTITION BY desk, concentration_type), 2) AS desk_hhi,
       pct_of_portfolio_total > 25 AS large_exposure_flag
FROM (SELECT e.*, round(gross_exposure_usd / nullif(d, 0) * 100, 4) AS pct_of_desk_total,
             round(gross_exposure_usd / nullif(t, 0) * 100, 4) AS pct_of_portfolio_total
      FROM entities e JOIN (SELECT desk, EXACT AS d FROM pos GROUP BY desk) USING (desk)
           CROSS JOIN (SELECT EXACT AS t FROM pos))
""".replace("EXACT", _exact("abs(notional_usd)"))

VIEWS["exposure_history"] = """
SELECT desk, as_of_date, gross_exposure_usd, avg(gross_exposure_usd) OVER (PARTITION BY desk) * 1.1 AS limit_usd,
       gross_exposure_usd / (avg(gross_exposure_usd) OVER (PARTITION BY desk) * 1.1) * 100 AS utilisation_pct
FROM (SELECT desk, CAST(date_trunc('month', trade_date) AS DATE) AS as_of_date, SUM(notional_usd) AS gross_exposure_usd
      FROM pos GROUP BY ALL)
"""

VIEWS["run_days"] = """
SELECT d, row_number() OVER (ORDER BY d) AS k, lead(d) OVER (ORDER BY d) AS nxt
FROM (SELECT DISTINCT as_of_date AS d FROM exposure_history)
"""

VIEWS["limit_breach_log"] = """
SELECT desk, breach_start_date, breach_end_date,
       CAST(CASE WHEN breach_end_date IS NOT NULL THEN datediff('day', breach_start_date, breach_end_date)
                 WHEN last_day = breach_start_date THEN 1
                 ELSE datediff('day', breach_start_date, last_day) END AS INTEGER) AS breach_duration_days,
       breach_end_date IS NULL AS is_active, peak_utilisation_pct, peak_utilisation_date,
       breach_start_utilisation_pct, limit_usd, gross_exposure_at_start_usd,
       CAST(NULL AS DATE) AS warning_start_date, CAST(NULL AS INTEGER) AS warning_duration_days
FROM (SELECT desk, min(as_of_date) AS breach_start_date, max(as_of_date) AS last_day,
             CASE WHEN max(k) < (SELECT max(k) FROM run_days) THEN max(nxt) END AS breach_end_date,
             max(u) AS peak_utilisation_pct, max(as_of_date) FILTER (WHERE u = top) AS peak_utilisation_date,
             arg_min(u, as_of_date) AS breach_start_utilisation_pct, arg_min(limit_usd, as_of_date) AS limit_usd,
             arg_min(gross_exposure_usd, as_of_date) AS gross_exposure_at_start_usd
      FROM (SELECT *, max(u) OVER (PARTITION BY desk, island) AS top
            FROM (SELECT *, round(utilisation_pct, 4) AS u,
                         SUM(opens) OVER (PARTITION BY desk ORDER BY as_of_date) AS island
                  FROM (SELECT *, CASE WHEN lag(k) OVER (PARTITION BY desk ORDER BY as_of_date) = k - 1 THEN 0 ELSE 1 END AS opens
                        FROM exposure_history JOIN run_days ON d = as_of_date WHERE utilisation_pct >= 100)))
      GROUP BY desk, island)
"""

# The same log of quarterly exposures.
_QUARTERS = {"'month'": "'quarter'", "exposure_history": "exposure_quarters", "run_days": "quarter_days"}
for _view in ("exposure_history", "run_days", "limit_breach_log"):
    _body = VIEWS[_view]
    for _month, _quarter in _QUARTERS.items():
        _body = _body.replace(_month, _quarter)
    VIEWS[_QUARTERS.get(_view, "quarter_breach_log")] = _body

VIEWS["risk_adjusted_performance"] = """
SELECT DATE '2001-12-31' AS calculation_date, p.desk, actual_pnl_usd, v.var_99_usd,
       CASE WHEN v.var_99_usd > 0 THEN round(actual_pnl_usd / v.var_99_usd, 4) END AS pnl_to_var_ratio,
       utilisation_pct AS limit_utilisation_pct,
       CASE WHEN utilisation_pct > 0 THEN actual_pnl_usd / utilisation_pct END AS pnl_per_unit_utilisation,
       CASE WHEN abs(actual_pnl_usd) > 0 THEN round(unexplained_pnl_usd / abs(actual_pnl_usd) * 100, 4) ELSE 0 END AS unexplained_pnl_pct,
       CASE WHEN actual_pnl_usd > v.var_99_usd THEN 'STRONG' WHEN actual_pnl_usd > 0 THEN 'ADEQUATE' ELSE 'LOSS' END AS performance_flag
FROM pnl_attribution p LEFT JOIN desk_var v USING (desk) LEFT JOIN exposure_monitor e ON e.desk = p.desk
"""

VIEWS["risk_summary"] = """
SELECT DATE '2001-12-31' AS summary_date, v.desk, total_notional_usd, v.var_99_usd, var_10day_97_5_usd, es_97_5_usd,
       round(v.var_99_usd / nullif(total_notional_usd, 0) * 100, 4) AS var_as_pct_of_notional,
       actual_pnl_usd, hypothetical_pnl_usd, unexplained_pnl_usd, gross_exposure_usd, limit_usd, utilisation_pct,
       limit_status, rolling_250d_exceptions, basel_zone, worst_stress_scenario, worst_stress_pnl_usd,
       largest_counterparty, largest_counterparty_pct,
       CASE WHEN breach_flag OR basel_zone = 'RED' OR abs(worst_stress_pnl_usd) > 2 * limit_usd THEN 'RED'
            WHEN utilisation_pct >= 80 OR basel_zone = 'AMBER' OR abs(worst_stress_pnl_usd) > limit_usd THEN 'AMBER'
            ELSE 'GREEN' END AS overall_risk_status
FROM desk_var v
     LEFT JOIN exposure_monitor e ON e.desk = v.desk
     LEFT JOIN pnl_attribution p ON p.desk = v.desk
     LEFT JOIN (SELECT desk, rolling_250d_exceptions, basel_zone FROM backtest_run
                WHERE backtest_date = DATE '2001-12-31') b ON b.desk = v.desk
     LEFT JOIN (SELECT desk, arg_min(scenario_name, stressed_pnl_usd) AS worst_stress_scenario,
                       min(stressed_pnl_usd) AS worst_stress_pnl_usd FROM stress_testing GROUP BY desk) s ON s.desk = v.desk
     LEFT JOIN (SELECT desk, entity_name AS largest_counterparty, pct_of_desk_total AS largest_counterparty_pct
                FROM concentration_risk WHERE concentration_type = 'COUNTERPARTY' AND desk_rank = 1) c ON c.desk = v.desk
"""


def compose(select: str) -> str:
    """``select`` preceded by the views it uses, directly or through others."""
    needed: set[str] = set()
    open_texts = [select]
    while open_texts:
        text = open_texts.pop()
        for name, body in VIEWS.items():
            if name not in needed and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                needed.add(name)
                open_texts.append(body)
    parts = [f"{name} AS ({body.strip()})" for name, body in VIEWS.items() if name in needed]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + select.strip()
