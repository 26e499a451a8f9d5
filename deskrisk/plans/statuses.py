"""What gates report, by the count that must be zero, in the order in which they are looked at."""

# The wording of every status.
STATUSES = {
    "prices_gate": (
        ("null_price_date", "FAIL - null price_date found"),
        ("null_ticker", "FAIL - null ticker found"),
        ("null_close_price", "FAIL - null close_price found"),
        ("duplicate_rows", "FAIL - duplicate rows found"),
        ("non_positive_close_price", "FAIL - non-positive close_price found"),
    ),
    "positions_gate": (
        ("null_trade_id", "FAIL — null trade_id found"),
        ("null_notional_usd", "FAIL — null notional_usd found"),
        ("null_fx_rate", "FAIL — null fx_rate found"),
        ("duplicate_trade_ids", "FAIL — duplicate trade_ids found"),
        ("non_positive_notional", "FAIL — non-positive notional found"),
        ("invalid_direction", "FAIL — invalid direction multiplier"),
    ),
    "var_gate": (
        ("null_var_95", "FAIL — null var_95 found"),
        ("null_var_97_5", "FAIL — null var_97_5 found"),
        ("null_var_99", "FAIL — null var_99 found"),
        ("null_var_10day", "FAIL — null var_10day found"),
        ("null_es", "FAIL — null es_97_5 found"),
        ("null_notional", "FAIL — null notional found"),
        ("var_97_5_less_than_95", "FAIL — var_97_5 less than var_95"),
        ("var_99_less_than_97_5", "FAIL — var_99 less than var_97_5"),
        ("es_less_than_var", "FAIL — ES less than VaR at same confidence level"),
        ("tenday_less_than_oneday", "FAIL — 10-day VaR less than 1-day VaR"),
        ("non_positive_var_95", "FAIL — non-positive var_95"),
        ("non_positive_es", "FAIL — non-positive ES"),
        ("low_scenario_count", "WARN — fewer than 200 scenarios used"),
    ),
    "pnl_gate": (
        ("null_hypothetical", "FAIL — null hypothetical_pnl found"),
        ("null_actual", "FAIL — null actual_pnl found"),
        ("null_unexplained", "FAIL — null unexplained_pnl found"),
        ("pnl_mismatch_rows", "FAIL — unexplained PnL arithmetic mismatch"),
    ),
    "backtest_gate": (
        ("null_var", "FAIL — null var found"),
        ("null_actual_loss", "FAIL — null actual_loss found"),
        ("null_rolling_count", "FAIL — null rolling count found"),
        ("null_basel_zone", "FAIL — null basel_zone found"),
        ("magnitude_on_non_exception", "FAIL — magnitude present on non-exception row"),
        ("missing_magnitude_on_exception", "FAIL — magnitude missing on exception row"),
        ("red_zone_mismatch", "FAIL — RED zone inconsistent with exception count"),
        ("amber_zone_mismatch", "FAIL — AMBER zone inconsistent with exception count"),
    ),
    "exposure_gate": (
        ("null_gross_exposure", "FAIL — null gross_exposure found"),
        ("null_limit", "FAIL — null limit found"),
        ("null_utilisation", "FAIL — null utilisation found"),
        ("null_limit_status", "FAIL — null limit_status found"),
        ("negative_gross_exposure", "FAIL — negative gross exposure found"),
        ("non_positive_limit", "FAIL — non-positive limit found"),
        ("red_flag_mismatch", "FAIL — RED status inconsistent with flags"),
        ("amber_flag_mismatch", "FAIL — AMBER status inconsistent with flags"),
        ("green_flag_mismatch", "FAIL — GREEN status inconsistent with flags"),
        ("invalid_status_values", "FAIL — invalid limit_status value found"),
    ),
    "validate_book": (
        ("duplicate_trade_ids", "FAIL — duplicate trade_ids"),
        ("bad_asset_class", "FAIL — unexpected asset_class"),
        ("bad_direction", "FAIL — unexpected direction"),
        ("bad_notional", "FAIL — non-positive notional"),
        ("bad_isin", "FAIL — ISIN not of 12 characters"),
        ("bad_cusip", "FAIL — CUSIP not of 9 characters"),
        ("fx_with_isin", "FAIL — FX position with ISIN"),
        ("fx_with_cusip", "FAIL — FX position with CUSIP"),
        ("equity_without_isin", "FAIL — Equity position without ISIN"),
        ("desk_class_mismatch", "FAIL — asset class outside the desk's mandate"),
    ),
}
