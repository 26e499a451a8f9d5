"""Columns each query returns and the decimals its floating-point results are cut to.

Sums of doubles depend on the order of addition, so two engines agree only up to the
last bits; both sides are rounded once, at the very end. Sums over one currency (a
counterparty has one, too) have few exact decimals, so that two places could fall on a
tie; six places hold them exactly.
Columns that no sum went into are compared as they are.
"""

from __future__ import annotations

from deskrisk.serving.charts import CHARTS, metric_name
from deskrisk.sources.schemas import GOLD

# Already rounded to four places by definition.
RATIOS = {
    "utilisation_pct", "coverage_pct", "stressed_loss_to_var_ratio", "stressed_loss_to_limit_pct",
    "pct_of_desk_total", "pct_of_portfolio_total", "desk_hhi", "pnl_to_var_ratio", "limit_utilisation_pct",
    "unexplained_pnl_pct", "var_as_pct_of_notional", "largest_counterparty_pct",
}
UNSUMMED = {"current_price", "fx_rate_vs_usd"} | RATIOS
PLACES = dict.fromkeys(
    ("fx_sensitivity", "rates_credit_sensitivity", "concentration_risk", "limit_breach_log"), 6
)


def places(table: str) -> dict[str, int]:
    """Decimals per double column of a gold table."""
    doubles = [f.name for f in GOLD[table] if f.dataType.simpleString() == "double"]
    return {c: PLACES.get(table, 2) for c in doubles if c not in UNSUMMED}


def chart_places(name: str) -> dict[str, int]:
    chart = CHARTS[name]
    of_table = places(chart.source)
    if not chart.metrics:
        return {c: n for c, n in of_table.items() if c in chart.columns}
    result = {}
    for metric in chart.metrics:
        column = metric.rstrip(")").split("(")[1]
        result[metric_name(metric)] = of_table.get(column, 4)
    return result
