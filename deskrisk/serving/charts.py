"""Dashboard datasets: one query shape, and a specification per chart."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

@dataclass(frozen=True)
class Chart:
    """What a chart shows of one gold table.

    With ``metrics``, rows are grouped by ``columns`` and each metric is an aggregate
    named ``<function>_<column>``; with ``distinct``, ``columns`` are grouped without
    a metric; otherwise they are shown row by row. ``order`` lists columns, a leading
    minus meaning descending; the remaining columns break ties. ``limit`` is for charts
    whose point is the first few rows; without it a chart has all rows.
    """

    source: str
    columns: tuple[str, ...]
    metrics: tuple[str, ...] = ()
    where: dict[str, str] = field(default_factory=dict)
    distinct: bool = False
    order: tuple[str, ...] = ()
    limit: int | None = None


def metric_name(metric: str) -> str:
    """``SUM(x)`` is called ``sum_x``."""
    function, column = metric.rstrip(")").split("(")
    return f"{function.lower()}_{column}"


def chart_query(
    df: DataFrame, chart: Chart, date_col: str | None = None, start: date | None = None, end: date | None = None
) -> DataFrame:
    """The chart's rows, for days from ``start`` up to but not including ``end``."""
    rows = df
    if start is not None:
        rows = rows.where(F.col(date_col) >= F.lit(start))
    if end is not None:
        rows = rows.where(F.col(date_col) < F.lit(end))
    for column, value in chart.where.items():
        rows = rows.where(F.col(column) == value)
    if chart.metrics:
        rows = rows.groupBy(*chart.columns).agg(*[F.expr(m).alias(metric_name(m)) for m in chart.metrics])
    elif chart.distinct:
        rows = rows.select(*chart.columns).distinct()
    else:
        rows = rows.select(*chart.columns)
    first = chart.order or tuple(f"-{metric_name(m)}" for m in chart.metrics[:1])
    named = {c.lstrip("-") for c in first}
    order = [F.desc_nulls_last(c[1:]) if c.startswith("-") else F.asc_nulls_last(c) for c in first]
    order += [F.asc_nulls_last(c) for c in rows.columns if c not in named]
    ordered = rows.orderBy(*order)
    return ordered if chart.limit is None else ordered.limit(chart.limit)


def _by(source: str, *columns: str, metrics: tuple[str, ...], limit: int | None = None, **where: str) -> Chart:
    return Chart(source, columns, metrics, where, limit=limit)


# Sources, columns and metrics of the charts.
CHARTS = {
    "ch01_risk_status": Chart(
        "risk_summary",
        ("desk", "overall_risk_status", "var_99_usd", "utilisation_pct", "worst_stress_pnl_usd"),
        order=("-utilisation_pct",),
    ),
    "ch02_var99_by_desk": _by("risk_summary", "desk", metrics=("SUM(var_99_usd)",)),
    "ch03_utilisation": _by("risk_summary", "desk", "limit_status", metrics=("SUM(utilisation_pct)",)),
    "ch04_worst_stress": _by(
        "risk_summary", "desk", "worst_stress_scenario", metrics=("MIN(worst_stress_pnl_usd)",)
    ),
    "ch05_top_counterparty": Chart(
        "risk_summary", ("desk", "largest_counterparty", "largest_counterparty_pct"),
        order=("-largest_counterparty_pct",), limit=10,
    ),
    "ch06_var_levels": _by(
        "var_daily", "desk", metrics=("SUM(var_95_usd)", "SUM(var_97_5_usd)", "SUM(var_99_usd)")
    ),
    "ch07_es_vs_var": _by("var_daily", "desk", metrics=("SUM(var_99_usd)", "SUM(es_97_5_usd)")),
    "ch08_var_10day": _by("var_daily", "desk", metrics=("SUM(var_10day_99_usd)",)),
    "ch09_var_detail": Chart(
        "var_daily",
        (
            "desk", "asset_class", "position_count", "total_notional_usd", "var_95_usd", "var_97_5_usd",
            "var_99_usd", "es_97_5_usd", "worst_day_loss_usd", "best_day_gain_usd", "scenario_count",
        ),
        order=("-var_99_usd",),
    ),
    "ch10_exposure_limit": _by("exposure_monitor", "desk", metrics=("SUM(gross_exposure_usd)", "SUM(limit_usd)")),
    "ch11_limit_utilisation": _by("exposure_monitor", "desk", "limit_status", metrics=("SUM(utilisation_pct)",)),
    "ch12_long_short_exposure": _by(
        "exposure_monitor", "desk", metrics=("SUM(long_exposure_usd)", "SUM(short_exposure_usd)")
    ),
    "ch13_limit_detail": Chart(
        "exposure_monitor",
        ("desk", "gross_exposure_usd", "net_exposure_usd", "limit_usd", "utilisation_pct", "limit_status"),
        distinct=True,
    ),
    "ch14_pnl_by_desk": _by("pnl_attribution", "desk", metrics=("SUM(actual_pnl_usd)",)),
    "ch15_actual_hypo": _by(
        "pnl_attribution", "desk", metrics=("SUM(actual_pnl_usd)", "SUM(hypothetical_pnl_usd)")
    ),
    "ch16_long_short_pnl": _by("pnl_attribution", "desk", metrics=("SUM(long_pnl_usd)", "SUM(short_pnl_usd)")),
    "ch17_unexplained": _by("pnl_attribution", "desk", metrics=("SUM(unexplained_pnl_usd)",)),
    "ch18_fx_delta": _by("fx_sensitivity", "currency", metrics=("SUM(fx_delta_1pct_usd)",)),
    "ch19_equity_delta": _by("equity_sensitivity", "sector", metrics=("SUM(equity_delta_1pct_usd)",)),
    "ch20_pv01_tenor": _by("rates_credit_sensitivity", "tenor_bucket", metrics=("SUM(pv01_usd)",)),
    "ch21_cs01_desk": _by("rates_credit_sensitivity", "desk", metrics=("SUM(cs01_usd)",)),
    "ch22_sens_detail": Chart(
        "rates_credit_sensitivity",
        ("desk", "asset_class", "tenor_bucket", "gross_notional_usd", "pv01_usd", "dv01_100bps_usd", "cs01_usd"),
        distinct=True,
    ),
    "ch23_stress_scenario": _by("stress_testing", "scenario_name", metrics=("SUM(stressed_pnl_usd)",)),
    "ch24_stress_desk": _by("stress_testing", "desk", metrics=("SUM(stressed_pnl_usd)",)),
    "ch25_stress_class": _by(
        "stress_testing", "scenario_name",
        metrics=(
            "SUM(stressed_pnl_equity_usd)", "SUM(stressed_pnl_fx_usd)",
            "SUM(stressed_pnl_rates_usd)", "SUM(stressed_pnl_credit_usd)",
        ),
    ),
    "ch26_loss_to_var": _by("stress_testing", "scenario_name", metrics=("AVG(stressed_loss_to_var_ratio)",)),
    "ch27_stress_detail": Chart(
        "stress_testing",
        (
            "desk", "scenario_name", "scenario_type", "stressed_pnl_usd", "worst_asset_class",
            "stressed_loss_to_var_ratio", "stressed_loss_to_limit_pct",
        ),
        distinct=True,
    ),
    "ch29_top_cp_exposure": _by(
        "concentration_risk", "entity_name", metrics=("SUM(pct_of_portfolio_total)",), limit=10,
        concentration_type="COUNTERPARTY",
    ),
    "ch30_by_asset_class": _by(
        "concentration_risk", "entity_name", metrics=("SUM(gross_exposure_usd)",),
        concentration_type="ASSET_CLASS",
    ),
    "ch31_geography": _by(
        "concentration_risk", "entity_name", metrics=("SUM(gross_exposure_usd)",),
        concentration_type="GEOGRAPHY",
    ),
    "ch32_sector": _by(
        "concentration_risk", "entity_name", metrics=("SUM(gross_exposure_usd)",), concentration_type="SECTOR"
    ),
    "ch33_maturity": _by(
        "concentration_risk", "entity_name", "desk", metrics=("SUM(gross_exposure_usd)",),
        concentration_type="MATURITY_BUCKET",
    ),
    "ch34_hhi": _by("concentration_risk", "desk", metrics=("SUM(desk_hhi)",)),
    "ch35_conc_detail": Chart(
        "concentration_risk",
        (
            "desk", "concentration_type", "entity_name", "gross_exposure_usd", "pct_of_desk_total",
            "concentration_level", "desk_rank",
        ),
        order=("desk_rank",),
    ),
}
