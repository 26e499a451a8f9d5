from datetime import date

import pytest
from pyspark.sql import functions as F

from deskrisk.functions import trade_noise
from deskrisk.plans.pnl import pnl_attribution, price_moves, risk_adjusted_performance

D1, D2, LATER = date(2026, 8, 1), date(2026, 8, 2), date(2026, 8, 9)


def test_moves_use_the_two_newest_days_up_to_the_run_date(closes, day):
    prices = closes(
        ("A", date(2026, 7, 1), 1.0), ("A", D1, 100.0), ("A", D2, 110.0), ("A", LATER, 999.0),
        ("ONE", D2, 5.0), ("ZERO", D1, 0.0), ("ZERO", D2, 5.0), ("FUTURE", LATER, 5.0),
    )
    moves = {r.ticker: r.daily_return for r in price_moves(prices, day).collect()}
    assert moves == {"A": pytest.approx(0.1), "ONE": None, "ZERO": None}


@pytest.mark.parametrize("noise", ["hash", "md5"])
def test_attribution_is_the_sum_over_trades(book, closes, day, noise):
    trades = [
        {"trade_id": f"T{i}", "ticker": t, "direction": s, "notional_usd": 1000.0 + i}
        for i, (t, s) in enumerate([("A", "LONG")] * 30 + [("A", "SHORT"), ("ONE", "LONG"), ("NONE", "LONG"), ("A", "FLAT")])
    ]
    positions = book(*trades)
    prices = closes(("A", D1, 100.0), ("A", D2, 110.0), ("ONE", D2, 5.0))
    r = pnl_attribution(positions, prices, day, noise).first()
    factors = {x[0]: x[1] for x in positions.select("trade_id", trade_noise(F.col("trade_id"), noise)).collect()}
    sides = {"LONG": 1, "SHORT": -1, "FLAT": 0}
    hypothetical = {t["trade_id"]: t["notional_usd"] * sides[t["direction"]] * 0.1 for t in trades if t["ticker"] == "A"}
    actual = {k: v * factors[k] for k, v in hypothetical.items()}
    assert r.position_count == 33  # the trade without any price is left out
    assert r.hypothetical_pnl_usd == pytest.approx(sum(hypothetical.values()))
    assert r.actual_pnl_usd == pytest.approx(sum(actual.values()))
    assert r.unexplained_pnl_usd == pytest.approx(r.actual_pnl_usd - r.hypothetical_pnl_usd)
    assert r.short_pnl_usd == pytest.approx(actual["T30"])
    assert r.long_pnl_usd == pytest.approx(r.actual_pnl_usd - r.short_pnl_usd)


def test_noise_is_within_a_percent_and_named(spark):
    ids = spark.range(500).select(F.concat(F.lit("T"), "id").alias("t"))
    for method in ("hash", "md5"):
        low, high = ids.select(trade_noise(F.col("t"), method).alias("n")).agg(F.min("n"), F.max("n")).first()
        assert 0.99 <= low < high <= 1.01
    with pytest.raises(ValueError, match="noise"):
        trade_noise(F.col("t"), "dice")


def performance(spark, day, pnl, unexplained=0.0, var=(60.0, 40.0), used=50.0):
    run = date(2026, 8, 3)
    p = spark.createDataFrame(
        [(run, "D", pnl, unexplained), (D1, "D", 7.0, 7.0)],
        "pnl_date date, desk string, actual_pnl_usd double, unexplained_pnl_usd double",
    )
    v = spark.createDataFrame(
        [(run, "D", x) for x in var] or [(D1, "D", 1.0)], "calculation_date date, desk string, var_99_usd double"
    )
    e = spark.createDataFrame([(run, "D", used)], "as_of_date date, desk string, utilisation_pct double")
    return risk_adjusted_performance(p, v, e, day).collect()


@pytest.mark.parametrize(
    "pnl, flag", [(150.0, "STRONG"), (100.0, "ADEQUATE"), (0.5, "ADEQUATE"), (0.0, "LOSS"), (-3.0, "LOSS")]
)
def test_performance_flags(spark, day, pnl, flag):
    (r,) = performance(spark, day, pnl)
    assert r.performance_flag == flag and r.var_99_usd == 100.0
    assert r.pnl_to_var_ratio == pytest.approx(pnl / 100) and r.pnl_per_unit_utilisation == pytest.approx(pnl / 50)


def test_performance_guards(spark, day):
    (r,) = performance(spark, day, 0.0, var=(), used=0.0)
    assert (r.var_99_usd, r.pnl_to_var_ratio, r.pnl_per_unit_utilisation, r.unexplained_pnl_pct) == (None, None, None, 0.0)
    (r,) = performance(spark, day, -8.0, unexplained=2.0, var=())
    assert r.unexplained_pnl_pct == 25.0 and r.performance_flag == "LOSS"
