"""Declared tables: column names, types and meaning, in table order.

``TABLES[name]`` is the StructType of a table, ``KEYS``, ``UPDATES`` and ``DATED``
say how gold tables are merged. A trailing ``!`` on a type marks NOT NULL.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_TYPES = {
    "string": StringType(),
    "double": DoubleType(),
    "int": IntegerType(),
    "boolean": BooleanType(),
    "date": DateType(),
    "timestamp": TimestampType(),
}


def _table(text: str) -> StructType:
    """One column per line: name, type, then what it means."""
    fields = []
    for line in text.strip().splitlines():
        name, kind, *meaning = line.split(None, 2)
        fields.append(
            StructField(
                name,
                _TYPES[kind.rstrip("!")],
                nullable=not kind.endswith("!"),
                metadata={"comment": meaning[0] if meaning else ""},
            )
        )
    return StructType(fields)


BRONZE = {
    "market_prices": _table(
        """
        Date          date       trading day
        Open          double     first price of the day
        High          double     highest price of the day
        Low           double     lowest price of the day
        Close         double     last price of the day
        Volume        double     units traded, NULL where the venue reports none
        ticker        string     vendor symbol, not yet normalised
        fetched_at    string     when the vendor was asked
        _source_file  string     landing file
        _ingested_at  timestamp  load time
        """
    ),
    "positions": _table(
        """
        trade_id         string     trade
        desk             string     owning desk
        book_id          string     book within the desk
        trader_id        string     trader
        counterparty     string     other side of the trade
        asset_class      string     FX, Equity, Rates or Credit
        instrument_type  string     product within the asset class
        ticker           string     normalised symbol
        isin             string     ISIN, NULL for FX
        cusip            string     CUSIP where there is one
        direction        string     LONG or SHORT
        notional         double     amount in the trade currency
        currency         string     trade currency
        trade_date       date       booking day
        maturity_date    date       day the trade ends
        generated_at     string     snapshot the row came with
        _source_file     string     landing file
        _ingested_at     timestamp  load time
        """
    ),
    "desk_limits": _table(
        """
        desk            string     desk
        limit_usd       double     gross exposure allowed
        limit_currency  string     currency of the limit
        effective_date  date       first day it holds
        review_date     date       day it is reviewed
        approved_by     string     approver
        uploaded_by     string     who loaded it
        approved_date   date       day of approval
        comments        string     free text
        _source_file    string     landing file
        _ingested_at    timestamp  load time
        """
    ),
    "fx_rates": _table(
        """
        currency      string     currency code
        rate_vs_usd   double     USD for one unit
        as_of_date    date       day of the rate
        generated_at  string     when it was derived
        _source_file  string     landing file
        _ingested_at  timestamp  load time
        """
    ),
}

SEEDS = {
    "stress_scenarios": _table(
        """
        scenario_name          string   scenario
        asset_class            string   class the shock applies to
        shock_pct              double   relative price shock, NULL for Rates and Credit
        shock_bps              double   yield or spread shock in basis points
        scenario_type          string   REGULATORY or MANAGEMENT
        is_stressed_var_proxy  boolean  stands in for stressed VaR
        """
    ),
    "ticker_classifications": _table(
        """
        ticker     string  normalised symbol
        sector     string  industry
        geography  string  region
        """
    ),
}

SILVER = {
    "prices_cleaned": _table(
        """
        price_date         date!      trading day
        open_price         double!    first price of the day
        high_price         double!    highest price of the day
        low_price          double!    lowest price of the day
        close_price        double!    last price of the day
        volume             double     units traded
        ticker             string!    normalised symbol
        fetched_at         string     when the vendor was asked
        _silver_loaded_at  timestamp  write time
        """
    ),
    "positions_enriched": _table(
        """
        trade_id              string!    trade, unique
        desk                  string!    owning desk
        book_id               string     book within the desk
        trader_id             string     trader
        counterparty          string!    other side of the trade
        asset_class           string!    FX, Equity, Rates or Credit
        instrument_type       string     product within the asset class
        ticker                string!    normalised symbol
        isin                  string     ISIN
        cusip                 string     CUSIP
        direction             string!    LONG or SHORT
        notional              double!    amount in the trade currency
        currency              string!    trade currency
        trade_date            date!      booking day
        maturity_date         date!      day the trade ends
        fx_rate_vs_usd        double!    rate used
        notional_usd          double!    notional in USD
        current_price         double     newest close, NULL without price history
        latest_price_date     date       day of that close
        market_value_usd      double     price, else notional, in USD
        days_to_maturity      int        calendar days left; negative once matured
        direction_multiplier  int!       1, -1 or 0
        net_exposure_usd      double!    signed notional in USD
        _silver_loaded_at     timestamp  write time
        """
    ),
}

# What a day's run needs of the days before it, so that it need not read them.
STATE = {
    "month_closes": _table(
        """
        price_month  date!    first day of the month
        ticker       string!  normalised symbol
        last_date    date!    newest day with a price in the month
        last_close   double!  its close
        prior_date   date     the day with a price before it, if in the month
        prior_close  double   its close
        """
    ),
    "trades_latest": StructType([*_table("trade_bucket  int!  hash of the trade"), *BRONZE["positions"]]),
    "backtest_window": _table(
        """
        desk           string!   owning desk
        backtest_date  date!     run day
        is_exception   boolean!  loss above VaR
        """
    ),
}

GOLD = {
    "var_daily": _table(
        """
        calculation_date      date!      run date
        desk                  string!    desk
        asset_class           string!    asset class
        position_count        int!       trades in the group
        total_notional_usd    double!    their notional
        var_95_usd            double!    one-day VaR at 95 %
        var_97_5_usd          double!    one-day VaR at 97.5 %
        var_99_usd            double!    one-day VaR at 99 %
        var_10day_95_usd      double!    ten-day VaR at 95 %
        var_10day_97_5_usd    double!    ten-day VaR at 97.5 %
        var_10day_99_usd      double!    ten-day VaR at 99 %
        es_97_5_usd           double!    expected shortfall beyond VaR 97.5
        avg_daily_return_usd  double     mean scenario P&L
        worst_day_loss_usd    double     lowest scenario P&L
        best_day_gain_usd     double     highest scenario P&L
        scenario_count        int!       scenario days
        _gold_loaded_at       timestamp  write time
        """
    ),
    "pnl_attribution": _table(
        """
        pnl_date              date!      run date
        desk                  string!    desk
        hypothetical_pnl_usd  double!    P&L of market moves alone
        actual_pnl_usd        double!    booked P&L
        unexplained_pnl_usd   double!    actual less hypothetical
        position_count        int!       trades with a price
        long_pnl_usd          double!    actual P&L of LONG trades
        short_pnl_usd         double!    actual P&L of SHORT trades
        _gold_loaded_at       timestamp  write time
        """
    ),
    "var_backtest": _table(
        """
        backtest_date            date!      day compared
        desk                     string!    desk
        var_97_5_usd             double!    predicted loss bound
        actual_loss_usd          double!    loss, positive when money was lost
        is_exception             boolean!   loss beyond the bound
        exception_magnitude      double     by how much, NULL otherwise
        rolling_250d_exceptions  int!       exceptions in the last 250 days
        basel_zone               string!    GREEN, AMBER or RED
        model_status             string!    ACCEPTED, REVIEW or REJECTED
        _gold_loaded_at          timestamp  write time
        """
    ),
    "exposure_monitor": _table(
        """
        as_of_date          date!      run date
        desk                string!    desk
        gross_exposure_usd  double!    sum of absolute notionals
        net_exposure_usd    double!    sum of signed notionals
        limit_usd           double!    limit in force
        utilisation_pct     double!    gross as a percentage of the limit
        limit_status        string!    GREEN, AMBER or RED
        warning_flag        boolean!   close to the limit
        breach_flag         boolean!   at or over the limit
        long_exposure_usd   double!    LONG notional
        short_exposure_usd  double!    SHORT notional
        position_count      int!       trades
        _gold_loaded_at     timestamp  write time
        """
    ),
    "fx_sensitivity": _table(
        """
        calculation_date       date!      run date
        desk                   string!    desk
        currency               string!    foreign currency
        asset_class            string!    asset class
        position_count         int!       trades
        long_position_count    int!       LONG trades
        short_position_count   int!       SHORT trades
        gross_notional_usd     double!    absolute notional
        long_notional_usd      double!    LONG notional
        short_notional_usd     double!    SHORT notional
        net_notional_usd       double!    signed notional
        net_open_position_usd  double!    larger of the two sides
        fx_rate_vs_usd         double!    rate used
        fx_delta_1pct_usd      double!    size of a 1 % move
        fx_delta_up_1pct_usd   double!    P&L when the currency gains 1 %
        fx_delta_down_1pct_usd double!    P&L when it loses 1 %
        _gold_loaded_at        timestamp  write time
        """
    ),
    "equity_sensitivity": _table(
        """
        calculation_date            date!      run date
        desk                        string!    desk
        ticker                      string!    symbol
        sector                      string!    industry, Unknown when unclassified
        geography                   string!    region, Unknown when unclassified
        position_count              int!       trades
        long_position_count         int!       LONG trades
        short_position_count        int!       SHORT trades
        gross_notional_usd          double!    absolute notional
        net_notional_usd            double!    signed notional
        current_price               double     newest close
        latest_price_date           date       day of that close
        equity_delta_1pct_usd       double!    size of a 1 % move
        equity_delta_up_1pct_usd    double!    P&L when the price gains 1 %
        equity_delta_down_1pct_usd  double!    P&L when it loses 1 %
        long_delta_usd              double!    1 % of the LONG side
        short_delta_usd             double!    1 % of the SHORT side
        _gold_loaded_at             timestamp  write time
        """
    ),
    "rates_credit_sensitivity": _table(
        """
        calculation_date             date!      run date
        desk                         string!    desk
        asset_class                  string!    Rates or Credit
        tenor_bucket                 string!    remaining life
        rate_currency                string!    currency of the curve
        position_count               int!       live trades
        matured_position_count       int!       matured trades of desk, class and currency
        gross_notional_usd           double!    absolute notional
        net_notional_usd             double!    signed notional
        weighted_avg_duration_years  double!    duration weighted by notional
        pv01_usd                     double!    size of 1 bp on rates
        pv01_up_1bp_usd              double!    P&L when rates rise 1 bp
        pv01_down_1bp_usd            double!    P&L when rates fall 1 bp
        dv01_100bps_usd              double!    size of 100 bp on rates
        cs01_usd                     double!    size of 1 bp on spreads
        cs01_widen_1bp_usd           double!    P&L when spreads widen 1 bp
        cs01_tighten_1bp_usd         double!    P&L when spreads tighten 1 bp
        cs01_100bps_usd              double!    size of 100 bp on spreads
        _gold_loaded_at              timestamp  write time
        """
    ),
    "stress_testing": _table(
        """
        calculation_date              date!      run date
        desk                          string!    desk
        scenario_name                 string!    scenario
        scenario_type                 string!    REGULATORY or MANAGEMENT
        is_stressed_var_proxy         boolean!   stands in for stressed VaR
        position_count                int!       trades the scenario touches
        total_notional_usd            double!    their absolute notional
        portfolio_total_notional_usd  double!    absolute notional of all desks
        coverage_pct                  double!    the first as a percentage of the second
        stressed_pnl_usd              double!    P&L under the scenario
        stressed_pnl_equity_usd       double!    its Equity part
        stressed_pnl_fx_usd           double!    its FX part
        stressed_pnl_rates_usd        double!    its Rates part
        stressed_pnl_credit_usd       double!    its Credit part
        worst_asset_class             string     class that loses most
        worst_asset_class_pnl_usd     double     its P&L
        var_99_usd                    double     desk VaR, summed over classes
        stressed_loss_to_var_ratio    double     size of the P&L over that VaR
        desk_limit_usd                double     limit in force
        stressed_loss_to_limit_pct    double     size of the P&L as a percentage of it
        _gold_loaded_at               timestamp  write time
        """
    ),
    "concentration_risk": _table(
        """
        as_of_date                date!      run date
        desk                      string!    desk
        concentration_type        string!    dimension
        entity_name               string!    value of the dimension
        position_count            int!       trades
        gross_exposure_usd        double!    absolute notional
        net_exposure_usd          double!    signed notional
        net_abs_exposure_usd      double!    its size
        pct_of_desk_total         double!    share of the desk
        pct_of_portfolio_total    double!    share of all desks
        concentration_level       string!    level by portfolio share
        desk_concentration_level  string!    level by desk share
        desk_rank                 int!       position within desk and dimension
        portfolio_rank            int!       position within the dimension
        desk_hhi                  double!    sum of squared desk shares
        large_exposure_flag       boolean!   more than a quarter of the portfolio
        _gold_loaded_at           timestamp  write time
        """
    ),
    "limit_breach_log": _table(
        """
        desk                          string!    desk
        breach_start_date             date!      first day over the limit
        breach_end_date               date       first day back under it
        breach_duration_days          int!       length so far
        is_active                     boolean!   still over the limit
        peak_utilisation_pct          double!    highest utilisation seen
        peak_utilisation_date         date!      last day it was seen
        breach_start_utilisation_pct  double!    utilisation on the first day
        limit_usd                     double!    limit on the first day
        gross_exposure_at_start_usd   double!    exposure on the first day
        warning_start_date            date       not filled
        warning_duration_days         int        not filled
        _gold_loaded_at               timestamp  write time
        """
    ),
    "risk_adjusted_performance": _table(
        """
        calculation_date          date!      run date
        desk                      string!    desk
        actual_pnl_usd            double!    booked P&L
        var_99_usd                double     desk VaR, summed over classes
        pnl_to_var_ratio          double     P&L over VaR
        limit_utilisation_pct     double     limit use
        pnl_per_unit_utilisation  double     P&L per point of limit use
        unexplained_pnl_pct       double!    unexplained as a percentage of P&L
        performance_flag          string!    STRONG, ADEQUATE or LOSS
        _gold_loaded_at           timestamp  write time
        """
    ),
    "risk_summary": _table(
        """
        summary_date              date!      run date
        desk                      string!    desk
        total_notional_usd        double!    notional
        var_99_usd                double!    VaR 99 %, summed over classes
        var_10day_97_5_usd        double!    ten-day VaR 97.5 %
        es_97_5_usd               double!    expected shortfall
        var_as_pct_of_notional    double     VaR as a percentage of notional
        actual_pnl_usd            double     booked P&L
        hypothetical_pnl_usd      double     P&L of market moves alone
        unexplained_pnl_usd       double     the difference
        gross_exposure_usd        double     gross exposure
        limit_usd                 double     limit in force
        utilisation_pct           double     limit use
        limit_status              string     GREEN, AMBER or RED
        rolling_250d_exceptions   int        backtest exceptions
        basel_zone                string     GREEN, AMBER or RED
        worst_stress_scenario     string     scenario that loses most
        worst_stress_pnl_usd      double     its P&L
        largest_counterparty      string     largest counterparty of the desk
        largest_counterparty_pct  double     its share of the desk
        overall_risk_status       string!    GREEN, AMBER or RED
        _gold_loaded_at           timestamp  write time
        """
    ),
}

TABLES = {**BRONZE, **SEEDS, **SILVER, **STATE, **GOLD}
LAYERS = {"bronze": {**BRONZE, **SEEDS}, "silver": SILVER, "state": STATE, "gold": GOLD}

# Merge key of each gold table and the date column it is partitioned by.
KEYS = {
    "var_daily": ("desk", "asset_class", "calculation_date"),
    "pnl_attribution": ("pnl_date", "desk"),
    "var_backtest": ("desk", "backtest_date"),
    "exposure_monitor": ("as_of_date", "desk"),
    "fx_sensitivity": ("calculation_date", "desk", "currency", "asset_class"),
    "equity_sensitivity": ("calculation_date", "desk", "ticker"),
    "rates_credit_sensitivity": ("calculation_date", "desk", "asset_class", "tenor_bucket", "rate_currency"),
    "stress_testing": ("calculation_date", "desk", "scenario_name"),
    "concentration_risk": ("as_of_date", "desk", "concentration_type", "entity_name"),
    "limit_breach_log": ("desk", "breach_start_date"),
    "risk_adjusted_performance": ("desk", "calculation_date"),
    "risk_summary": ("summary_date", "desk"),
}
DATED = {
    name: next(k for k in keys if k.endswith("_date")) for name, keys in KEYS.items()
}

# Columns an upsert does not touch on a row that is already there, besides its key:
# facts about the first day of a breach.
_KEPT = {"limit_breach_log": {"breach_start_utilisation_pct", "limit_usd", "gross_exposure_at_start_usd"}}
UPDATES = {
    name: tuple(c for c in GOLD[name].names if c not in keys and c not in _KEPT.get(name, ()))
    for name, keys in KEYS.items()
}


def business_columns(table: str) -> list[str]:
    """Columns without the audit ones (leading underscore)."""
    return [c for c in TABLES[table].names if not c.startswith("_")]
