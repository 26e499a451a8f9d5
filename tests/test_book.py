"""The models give the same on the book as on the trades it was summed from."""

import random
from datetime import date, timedelta

import pytest
from table_rows import rows
from pyspark.sql import functions as F

from deskrisk.operators import settle
from deskrisk.plans.book import KEYS, position_book, trade_measures
from deskrisk.plans.exposure import exposure_monitor
from deskrisk.plans.pnl import pnl_attribution
from deskrisk.plans.sensitivity import equity_sensitivity, fx_sensitivity, rates_credit_sensitivity
from deskrisk.plans.stress import stress_testing
from deskrisk.plans.value_at_risk import var_daily


@pytest.fixture(scope="module")
def trades(book):
    """Half of the trades share one desk, ticker and currency."""
    rng = random.Random(2)
    return book(
        *[
            {
                "trade_id": f"T{i}", "desk": "FX Desk" if i % 2 else rng.choice("AB"),
                "asset_class": rng.choice(("FX", "Equity", "Rates", "Credit")),
                "ticker": "HOT" if i % 2 else rng.choice(("HOT", "T1", "T2")),
                "direction": rng.choice(("LONG", "SHORT", "FLAT")), "currency": "EUR" if i % 2 else rng.choice(("USD", "JPY")),
                "notional_usd": rng.uniform(1, 1e6), "days_to_maturity": rng.choice((None, -1, 10, 700, 2000, 9000)),
                "current_price": 7.0, "latest_price_date": date(2026, 8, 1),
            }
            for i in range(400)
        ]
    )


@pytest.fixture(scope="module")
def summed(trades):
    return settle(position_book(trades), "book")


def test_book_is_smaller_and_complete(trades, summed):
    assert summed.count() == trade_measures(trades).select(*KEYS).distinct().count() < 400
    total = summed.agg(F.sum("trades"), F.sum("notional_usd")).first()
    assert total[0] == 400 and total[1] == pytest.approx(trades.agg(F.sum("notional_usd")).first()[0])


def models(spark, closes, day):
    start = date(2026, 1, 1)
    rng = random.Random(4)
    prices = closes(*[(t, start + timedelta(days=i), 50 + rng.random()) for t in ("HOT", "T1") for i in range(60)])
    limits = spark.createDataFrame([(d, 1e8, start) for d in ("FX Desk", "A", "B")], "desk string, limit_usd double, approved_date date")
    classes = spark.createDataFrame([("HOT", "S", "G")], "ticker string, sector string, geography string")
    scenarios = spark.createDataFrame(
        [("X", "FX", -0.1, None, "R", False), ("X", "Rates", None, 90.0, "R", True)],
        "scenario_name string, asset_class string, shock_pct double, shock_bps double, scenario_type string, is_stressed_var_proxy boolean",
    )
    var = spark.createDataFrame([(date(2026, 8, 3), "A", 5.0)], "calculation_date date, desk string, var_99_usd double")
    return {
        "var": lambda p: var_daily(p, prices, day),
        "pnl": lambda p: pnl_attribution(p, prices, day),
        "exposure": lambda p: exposure_monitor(p, limits, day),
        "fx": lambda p: fx_sensitivity(p, day),
        "equity": lambda p: equity_sensitivity(p, classes, day),
        "rates": lambda p: rates_credit_sensitivity(p, day),
        "stress": lambda p: stress_testing(p, scenarios, var, limits, day),
    }


@pytest.mark.parametrize("name", ["var", "pnl", "exposure", "fx", "equity", "rates", "stress"])
def test_model_on_the_book(spark, trades, summed, closes, day, name):
    model = models(spark, closes, day)[name]
    keys = [c for c, t in model(trades).dtypes if t in ("string", "date")]
    one, many = rows(model(summed), *keys), rows(model(trades), *keys)
    assert len(one) == len(many) > 0
    for a, b in zip(one, many):
        for c in a:
            want = b[c]
            assert a[c] == (pytest.approx(want, rel=1e-9, abs=1e-6) if isinstance(want, float) else want), c
