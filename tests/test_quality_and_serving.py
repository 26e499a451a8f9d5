from datetime import date

import pytest
from table_rows import rows

from deskrisk.operators import checks
from deskrisk.plans import gates
from deskrisk.serving import reports
from deskrisk.serving.charts import CHARTS, Chart, chart_query
from deskrisk.sources.schemas import GOLD

D1, D2 = date(2026, 8, 1), date(2026, 8, 2)


def failures(df):
    return {r.check_name: r.failures for r in df.collect()}


def test_checks_count_failures(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), (None, 2), (None, 2)], "k string, n int")
    assert failures(checks.check_not_null(df, "k")) == {"not_null_k": 2}
    assert failures(checks.check_unique(df, "k")) == {"unique_k": 1}
    assert failures(checks.check_unique_combination(df, ["k", "n"])) == {"unique_k_n": 2}
    assert failures(checks.check_accepted_values(df, "k", ["a"])) == {"accepted_k": 1}
    assert failures(checks.column_checks(df, ["k", "n"], {"n": [1]})) == {"not_null_k": 2, "not_null_n": 1, "accepted_n": 2}
    assert failures(checks.check_not_null(df.limit(0), "k")) == {"not_null_k": 0}


def test_failing_check_or_gate_stops_and_warning_does_not(spark):
    df = spark.createDataFrame([(None,)], "k string")
    with pytest.raises(checks.QualityError, match="table: not_null_k: 1"):
        checks.stop_on_fail(checks.check_not_null(df, "k"), "table")
    checks.stop_on_fail(spark.createDataFrame([("WARN: few",)], "quality_status string"), "x")
    with pytest.raises(checks.QualityError, match="FAIL"):
        checks.stop_on_fail(spark.createDataFrame([("FAIL - bad",)], "quality_status string"), "x")


def status(df):
    return df.first().quality_status


def test_prices_gate_order_and_null_counts(spark):
    schema = "ticker string, price_date date, close_price double"
    good = [("A", D1, 1.0), ("A", D2, 1.0), ("B", D1, 2.0)]
    r = gates.prices_gate(spark.createDataFrame(good, schema)).first()
    assert (r.total_rows, r.unique_tickers, r.unique_dates, r.earliest_date, r.latest_date) == (3, 2, 2, D1, D2)
    assert r.null_ticker is None and r.duplicate_rows == 0 and r.quality_status == "PASS"

    def verdict(*extra):
        return status(gates.prices_gate(spark.createDataFrame([*good, *extra], schema)))

    assert verdict(("A", D1, 5.0)) == "FAIL - duplicate rows found"
    assert verdict(("C", D1, -5.0)) == "FAIL - non-positive close_price found"
    assert verdict((None, D1, -5.0)) == "FAIL - null ticker found"
    # Keys that would run together as text are still two keys.
    assert verdict(("C", None, 1.0), (None, None, 1.0)).startswith("FAIL - null price_date")


def test_positions_gate_and_breakdown(book):
    good = book({"current_price": 1.0}, {"direction": "SHORT", "desk": "Rates Desk", "notional_usd": 500.0})
    r = gates.positions_gate(good).first()
    assert (r.total_rows, r.unique_desks, r.positions_with_price, r.positions_without_price) == (2, 2, 1, 1)
    assert r.quality_status == "PASS"
    assert status(gates.positions_gate(book({"direction": "FLAT"}))) == "FAIL — invalid direction multiplier"
    assert status(gates.positions_gate(book({"trade_id": "x"}, {"trade_id": "x"}))) == "FAIL — duplicate trade_ids found"
    first = gates.desk_breakdown(good).first()
    assert (first.desk, first.short_positions, first.net_exposure_usd) == ("Rates Desk", 1, -500.0)


def gold(spark, table, **values):
    schema = GOLD[table]
    defaults = {"string": "FX Desk", "double": 1.0, "int": 300, "boolean": False, "date": D1, "timestamp": None}
    line = tuple(values.get(f.name, defaults[f.dataType.simpleString()]) for f in schema)
    relaxed = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    return spark.createDataFrame([line], relaxed)


@pytest.mark.parametrize(
    "gate, table, base, broken, reason",
    [
        (gates.var_gate, "var_daily", {"var_99_usd": 3.0}, {"var_95_usd": None}, "null var_95"),
        (gates.var_gate, "var_daily", {}, {"var_95_usd": 2.0}, "var_97_5 less than var_95"),
        (gates.var_gate, "var_daily", {}, {"es_97_5_usd": 0.5}, "ES less than VaR"),
        (gates.var_gate, "var_daily", {}, {"scenario_count": 199}, "WARN — fewer than 200"),
        (gates.pnl_gate, "pnl_attribution", {"unexplained_pnl_usd": 0.0}, {"unexplained_pnl_usd": 0.02}, "mismatch"),
        (gates.backtest_gate, "var_backtest", {"exception_magnitude": None, "basel_zone": "RED"}, {"exception_magnitude": 1.0}, "present on"),
        (gates.backtest_gate, "var_backtest", {"exception_magnitude": None}, {"is_exception": True, "exception_magnitude": None}, "missing on"),
        (gates.backtest_gate, "var_backtest", {"exception_magnitude": None}, {"basel_zone": "AMBER"}, "AMBER zone"),
        (gates.exposure_gate, "exposure_monitor", {"limit_status": "GREEN"}, {"breach_flag": True}, "GREEN status"),
        (gates.exposure_gate, "exposure_monitor", {"limit_status": "GREEN"}, {"limit_status": "BLUE"}, "invalid limit_status"),
    ],
)
def test_gold_gates(spark, gate, table, base, broken, reason):
    assert status(gate(gold(spark, table, **base))) == "PASS"
    assert reason in status(gate(gold(spark, table, **{**base, **broken})))


BOOK = "trade_id string, desk string, asset_class string, instrument_type string, direction string, notional double, isin string, cusip string"


@pytest.mark.parametrize(
    "change, reason",
    [
        ({}, "PASS"), ({"asset_class": "Gold"}, "unexpected asset_class"), ({"direction": None}, "unexpected direction"),
        ({"notional": 0.0}, "non-positive"), ({"isin": "SHORT"}, "12 characters"), ({"cusip": "12345678"}, "9 characters"),
        ({"isin": None}, "without ISIN"), ({"desk": "FX Desk"}, "mandate"),
        ({"desk": "FX Desk", "asset_class": "FX"}, "FX position with ISIN"),
    ],
)
def test_book_rules(spark, change, reason):
    line = {
        "trade_id": "EQ-1", "desk": "Equity Desk", "asset_class": "Equity", "instrument_type": "EQUITY",
        "direction": "LONG", "notional": 5.0, "isin": "DK0062498333", "cusip": None, **change,
    }
    assert reason in status(gates.validate_book(spark.createDataFrame([tuple(line.values())], BOOK)))


def test_desk_argument():
    assert reports.desk_argument("ALL") is None
    assert reports.desk_argument("fx desk") == "FX Desk"
    for bad in ("Nope", "FX Desk' OR '1'='1"):
        with pytest.raises(reports.UnknownDeskError, match="valid desks"):
            reports.desk_argument(bad)


def test_reports_show_the_newest_day_only(spark):
    var = gold(spark, "var_daily", calculation_date=D2, var_99_usd=5.0).union(
        gold(spark, "var_daily", calculation_date=D2, desk="Rates Desk", var_99_usd=9.0)
    ).union(gold(spark, "var_daily", var_99_usd=99.0))
    assert [(r.desk, r.var_99_usd) for r in reports.var_report(var).collect()] == [("Rates Desk", 9.0), ("FX Desk", 5.0)]
    assert [r.desk for r in reports.var_report(var, "RATES desk").collect()] == ["Rates Desk"]
    exposure = gold(spark, "exposure_monitor", breach_flag=True).union(
        gold(spark, "exposure_monitor", as_of_date=D2, breach_flag=True, utilisation_pct=101.0, desk="A")
    ).union(gold(spark, "exposure_monitor", as_of_date=D2, desk="B"))
    assert [r.desk for r in reports.active_breaches(exposure).collect()] == ["A"]
    pnl = gold(spark, "pnl_attribution", actual_pnl_usd=1.005, hypothetical_pnl_usd=1.0).union(
        gold(spark, "pnl_attribution", desk="B", actual_pnl_usd=-8.0)
    )
    assert [r.desk for r in reports.pnl_summary(pnl).collect()] == ["B", "FX Desk"]
    assert rows(reports.desk_filter(exposure, ["A"]).select("desk")) == [{"desk": "A"}]


def test_one_broken_table_does_not_hide_the_others(spark, tmp_path):
    spark.range(7).write.parquet(str(tmp_path / "ok"))
    out = rows(reports.table_health(spark, {"ok": str(tmp_path / "ok"), "gone": str(tmp_path / "gone")}), "table_name")
    assert out[0]["row_count"] is None and out[0]["error"] == "PATH_NOT_FOUND"
    assert (out[1]["row_count"], out[1]["error"]) == (7, None)


def test_chart_shapes(spark):
    df = spark.createDataFrame(
        [("a", "X", 1.0, D1), ("b", "X", 5.0, D1), ("a", "X", 2.0, D2), ("c", "Y", 9.0, D2)], "g string, kind string, v double, d date"
    )
    chart = Chart("t", ("g",), ("SUM(v)",), {"kind": "X"}, limit=1)
    assert rows(chart_query(df, chart)) == [{"g": "b", "sum_v": 5.0}]
    assert [r.v for r in chart_query(df, Chart("t", ("v",), order=("-v",), limit=2)).collect()] == [9.0, 5.0]
    assert chart_query(df, Chart("t", ("kind",), distinct=True)).count() == 2
    dated = chart_query(df, Chart("t", ("v",), order=("v",)), "d", D1, D2)
    assert [r.v for r in dated.collect()] == [1.0, 5.0]


def test_every_chart_names_columns_of_its_table(spark):
    assert len(CHARTS) == 34
    for name, chart in CHARTS.items():
        empty = spark.createDataFrame([], GOLD[chart.source])
        assert chart_query(empty, chart).columns, name


def test_load_audit(spark):
    a = spark.createDataFrame([("l1",), ("l1",), ("l2",)], "stamp string")
    b = spark.createDataFrame([(D1,)], "day date")
    out = gates.bronze_load_audit({"a": (a, "stamp"), "b": (b, "day")}).collect()
    assert [tuple(r) for r in out] == [("a", "l1", 2), ("a", "l2", 1), ("b", "2026-08-01", 1)]


def test_gates_do_not_repeat_rows_for_several_distincts(spark):
    trades = spark.createDataFrame(
        [("T1", "FX Desk", "A", "FX", "USD", "LONG", 1.0, 1.0, 1, 1.0, None)],
        "trade_id string, desk string, counterparty string, asset_class string, currency string, direction string, "
        "notional_usd double, net_exposure_usd double, direction_multiplier int, fx_rate_vs_usd double, current_price double",
    )
    prices = spark.createDataFrame([("A", date(2026, 1, 1), 1.0)], "ticker string, price_date date, close_price double")
    for df in (gates.positions_gate(trades), gates.desk_breakdown(trades), gates.prices_gate(prices), gates.silver_summary(prices, trades)):
        assert "Expand" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert gates.positions_gate(trades).first().unique_desks == 1


def test_values_without_a_bound_are_not_gathered_in_one_buffer(spark):
    schema = "desk string, counterparty string, asset_class string, direction string, notional_usd double, net_exposure_usd double"
    rows = [("a", f"c{k % 3}", "FX", "LONG", 1.0, 1.0) for k in range(7)] + [("a", None, "FX", "SHORT", 1.0, 1.0)]
    found = gates.desk_breakdown(spark.createDataFrame(rows, schema))
    assert "collect_set(counterparty" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.first().unique_counterparties == 3
    prices = spark.createDataFrame([("2026-08-03", "T", 1.0)], "price_date string, ticker string, close_price double")
    assert "collect_set(ticker" not in gates.prices_gate(prices)._jdf.queryExecution().optimizedPlan().toString()
