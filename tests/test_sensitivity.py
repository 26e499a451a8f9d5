import pytest
from table_rows import rows

from deskrisk.plans.sensitivity import equity_sensitivity, fx_sensitivity, rates_credit_sensitivity


def test_fx_sides_and_open_position(book, day):
    out = rows(
        fx_sensitivity(
            book(
                {"notional_usd": 10.0}, {"notional_usd": 4.0, "direction": "SHORT"},
                {"notional_usd": 9.0, "direction": "SHORT"}, {"notional_usd": 2.0, "direction": "FLAT"},
                {"notional_usd": 50.0, "currency": "USD"}, {"notional_usd": 60.0, "currency": "usd"},
                {"notional_usd": 1.0, "currency": "JPY", "fx_rate_vs_usd": 0.5},
            ),
            day,
        ),
        "currency",
    )
    assert [r["currency"] for r in out] == ["EUR", "JPY"]
    r = out[0]
    assert (r["position_count"], r["long_position_count"], r["short_position_count"]) == (4, 1, 2)
    assert (r["long_notional_usd"], r["short_notional_usd"], r["gross_notional_usd"]) == (10.0, 13.0, 25.0)
    assert r["net_notional_usd"] == -3.0 and r["net_open_position_usd"] == 13.0
    assert r["fx_delta_1pct_usd"] == pytest.approx(0.03)
    assert r["fx_delta_up_1pct_usd"] == pytest.approx(-0.03) == -r["fx_delta_down_1pct_usd"]
    assert out[1]["fx_rate_vs_usd"] == 0.5


def test_equity_only_and_unknown_class(spark, book, day):
    classes = spark.createDataFrame([("nvo", "Health", "Europe")], "ticker string, sector string, geography string")
    out = rows(
        equity_sensitivity(
            book(
                {"asset_class": "EQUITY", "ticker": "NVO", "notional_usd": 10.0, "current_price": 3.0},
                {"asset_class": "Equity", "ticker": "NVO", "notional_usd": 30.0, "direction": "SHORT", "current_price": 3.0},
                {"asset_class": "Equity", "ticker": "ZZZ"}, {"asset_class": "Rates", "ticker": "NVO"},
            ),
            classes,
            day,
        ),
        "ticker",
    )
    nvo, zzz = out
    assert (nvo["sector"], nvo["geography"], zzz["sector"], zzz["geography"]) == ("Health", "Europe", "Unknown", "Unknown")
    assert (nvo["position_count"], nvo["long_position_count"], nvo["short_position_count"]) == (2, 1, 1)
    assert nvo["equity_delta_up_1pct_usd"] == pytest.approx(-0.2) and nvo["equity_delta_1pct_usd"] == pytest.approx(0.2)
    assert nvo["long_delta_usd"] == pytest.approx(0.1) and nvo["short_delta_usd"] == pytest.approx(0.3)
    assert nvo["current_price"] == 3.0 and zzz["current_price"] is None


def test_long_bond_loses_when_rates_rise(book, day):
    r = rates_credit_sensitivity(
        book({"asset_class": "Rates", "notional_usd": 1e6, "days_to_maturity": 730}), day
    ).first()
    assert r.pv01_up_1bp_usd == pytest.approx(-200.0) == -r.pv01_down_1bp_usd
    assert r.pv01_usd == pytest.approx(200.0) and r.dv01_100bps_usd == pytest.approx(20_000.0)
    assert (r.cs01_usd, r.cs01_widen_1bp_usd, r.cs01_100bps_usd) == (0.0, 0.0, 0.0)
    assert r.weighted_avg_duration_years == pytest.approx(2.0) and r.tenor_bucket == "1-5Y"


def test_short_credit_gains_when_spreads_widen(book, day):
    r = rates_credit_sensitivity(
        book({"asset_class": "CREDIT", "notional_usd": 1e6, "days_to_maturity": 365, "direction": "SHORT"}), day
    ).first()
    assert r.cs01_widen_1bp_usd == pytest.approx(100.0) and r.cs01_tighten_1bp_usd == pytest.approx(-100.0)
    assert r.pv01_usd == 0.0 and r.tenor_bucket == "0-1Y"


def test_buckets_and_matured_counts(book, day):
    def bond(days, currency="EUR"):
        return {"asset_class": "Rates", "days_to_maturity": days, "currency": currency}

    out = rows(
        rates_credit_sensitivity(
            book(*[bond(d) for d in (1, 365, 366, 1825, 1826, 3650, 3651, 0, -5, None)], bond(-1, "JPY"), bond(9, "GBP")), day
        ),
        "rate_currency", "tenor_bucket",
    )
    assert [(r["rate_currency"], r["tenor_bucket"], r["position_count"], r["matured_position_count"]) for r in out] == [
        ("EUR", "0-1Y", 2, 3), ("EUR", "1-5Y", 2, 3), ("EUR", "10Y+", 1, 3), ("EUR", "5-10Y", 2, 3), ("GBP", "0-1Y", 1, 0),
    ]


def test_zero_notional_has_no_duration(book, day):
    r = rates_credit_sensitivity(book({"asset_class": "Rates", "notional_usd": 0.0}), day).first()
    assert r.weighted_avg_duration_years is None
