"""VaR against brute force over every trade, and the backtest's rolling window."""

import math
import random
from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from table_rows import rows
from pyspark.sql import functions as F

from deskrisk.plans.value_at_risk import daily_returns, var_backtest, var_daily

START = date(2024, 1, 1)


def series(ticker, days, seed, start=START):
    rng = random.Random(seed)
    level, out = 100.0, []
    for i in range(days):
        level *= 1 + rng.uniform(-0.04, 0.04)
        out.append((ticker, start + timedelta(days=i), level))
    return out


def brute_force_returns(prices, lookback):
    frame = pd.DataFrame(prices, columns=["ticker", "day", "close"]).sort_values(["ticker", "day"])
    frame["prev"] = frame.groupby("ticker")["close"].shift()
    first = frame["day"].max() - timedelta(days=lookback)
    frame = frame[(frame["day"] >= first) & (frame["prev"] > 0)]
    frame["ret"] = (frame["close"] - frame["prev"]) / frame["prev"]
    return frame


def test_returns_need_one_close_before_the_lookback(closes):
    prices = series("A", 500, 1) + series("B", 90, 2) + series("GONE", 30, 3)
    want = {(r.ticker, r.day): r.ret for r in brute_force_returns(prices, 365).itertuples()}
    have = {(r.ticker, r.price_date): r.daily_return for r in daily_returns(closes(*prices)).collect()}
    assert have == pytest.approx(want) and len(have) == 366
    assert not any(t == "GONE" for t, _ in have)


def test_returns_skip_non_positive_closes_and_respect_as_of(closes):
    d = [START + timedelta(days=i) for i in range(4)]
    prices = closes(("A", d[0], 0.0), ("A", d[1], 10.0), ("A", d[2], 11.0), ("A", d[3], 22.0))
    assert [r["daily_return"] for r in rows(daily_returns(prices), "price_date")] == pytest.approx([0.1, 1.0])
    assert daily_returns(prices, as_of=F.lit(d[2])).count() == 1


@pytest.fixture(scope="module")
def market():
    return [p for i, t in enumerate(("A", "B", "C", "D")) for p in series(t, 420, 10 + i)]


@pytest.fixture(scope="module")
def trades():
    """A third and more of all trades share one ticker."""
    rng = random.Random(5)
    return [
        {
            "trade_id": f"T{i}", "desk": rng.choice(("FX Desk", "Macro Desk")),
            "asset_class": rng.choice(("FX", "Rates")), "ticker": rng.choice(("A", "A", "A", "B", "C", "NONE")),
            "direction": rng.choice(("LONG", "SHORT", "FLAT")), "notional_usd": rng.uniform(1, 1000),
        }
        for i in range(300)
    ]


def test_var_equals_brute_force_over_trades(book, closes, market, trades, day):
    returns = brute_force_returns(market, 365)
    frame = pd.DataFrame(trades)
    frame["side"] = frame["direction"].map({"LONG": 1, "SHORT": -1}).fillna(0)
    each = frame.merge(returns, on="ticker")
    each["pnl"] = each["notional_usd"] * each["ret"] * each["side"]
    keys = ["desk", "asset_class"]
    scenarios = each.groupby([*keys, "day"]).agg(
        pnl=("pnl", "sum"), n=("trade_id", "nunique"), notional=("notional_usd", "sum")
    ).reset_index()
    have = {(r.desk, r.asset_class): r for r in var_daily(book(*trades), closes(*market), day).collect()}
    assert len(have) == 4
    for key, group in scenarios.groupby(keys):
        r, pnl = have[key], group["pnl"]
        v95, v975, v99 = (abs(np.quantile(pnl, p)) for p in (0.05, 0.025, 0.01))
        assert (r.var_95_usd, r.var_97_5_usd, r.var_99_usd) == pytest.approx((v95, v975, v99))
        assert r.es_97_5_usd == pytest.approx(abs(pnl[pnl < -v975].mean()))
        assert r.var_10day_99_usd == pytest.approx(v99 * math.sqrt(10))
        assert (r.worst_day_loss_usd, r.best_day_gain_usd) == pytest.approx((pnl.min(), pnl.max()))
        assert r.avg_daily_return_usd == pytest.approx(pnl.mean())
        assert (r.position_count, r.scenario_count) == (group["n"].max(), len(group))
        assert r.total_notional_usd == pytest.approx(group["notional"].max())
        assert r.var_95_usd <= r.var_97_5_usd <= r.var_99_usd and r.es_97_5_usd >= r.var_97_5_usd


def test_shortfall_falls_back_to_var_when_nothing_is_worse(book, closes, day):
    prices = [("A", START + timedelta(days=i), 100.0 * 1.01**i) for i in range(30)]
    r = var_daily(book({"ticker": "A"}), closes(*prices), day).first()
    assert r.var_97_5_usd == pytest.approx(1.0) and r.es_97_5_usd == pytest.approx(1.0)


def test_backtest_window_zones_and_desk_maximum(spark):
    days = [START + timedelta(days=i) for i in range(300)]
    # A loss of 10 every tenth day, against class VaRs of 3 and 5.
    pnl = spark.createDataFrame(
        [(d, "D", -10.0 if i % 10 == 0 else 1.0) for i, d in enumerate(days)],
        "pnl_date date, desk string, actual_pnl_usd double",
    )
    var = spark.createDataFrame(
        [(d, "D", c, v) for d in days for c, v in (("FX", 3.0), ("Rates", 5.0))],
        "calculation_date date, desk string, asset_class string, var_97_5_usd double",
    )
    out = rows(var_backtest(var, pnl), "backtest_date")
    assert all(r["var_97_5_usd"] == 5.0 for r in out)
    assert out[0]["is_exception"] and out[0]["exception_magnitude"] == 5.0
    assert not out[1]["is_exception"] and out[1]["exception_magnitude"] is None
    losses = [r["is_exception"] for r in out]
    assert [r["rolling_250d_exceptions"] for r in out] == [sum(losses[max(0, i - 249) : i + 1]) for i in range(300)]
    by_count = {r["rolling_250d_exceptions"]: (r["basel_zone"], r["model_status"]) for r in out}
    assert by_count[4] == ("GREEN", "ACCEPTED") and by_count[5] == by_count[9] == ("AMBER", "REVIEW")
    assert by_count[10] == by_count[25] == ("RED", "REJECTED")


def test_backtest_needs_both_sides(spark):
    pnl = spark.createDataFrame([(START, "A", -1.0)], "pnl_date date, desk string, actual_pnl_usd double")
    var = spark.createDataFrame([(START, "B", 1.0)], "calculation_date date, desk string, var_97_5_usd double")
    assert var_backtest(var, pnl).isEmpty()
