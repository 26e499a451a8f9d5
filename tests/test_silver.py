"""Cleaning, deduplication and enrichment, each on rows written down here."""

from datetime import date, datetime

import pytest
from table_rows import rows
from pyspark.sql import functions as F

from deskrisk.plans.silver import latest_rates, positions_enriched, prices_cleaned

PRICE = (
    "Date date, Open double, High double, Low double, Close double, Volume double, ticker string, "
    "fetched_at string, _ingested_at timestamp"
)


def price(day, close, ticker, load=1, **other):
    values = {"Open": 10.0, "High": 12.0, "Low": 9.0, "Volume": 5.0, **other}
    return (
        date(2026, 7, day) if day else None, values["Open"], values["High"], values["Low"], close,
        values["Volume"], ticker, f"load-{load}", datetime(2026, 7, 30, load),
    )


def test_incomplete_prices_are_dropped_and_tickers_normalised(spark):
    bronze = spark.createDataFrame(
        [
            price(1, 1.08, "EURUSD=X"), price(2, None, "EURUSD=X"), price(1, 712.5, "VOD.L"),
            price(3, 7.0, "VOD.L", Open=None), price(4, 7.0, "VOD.L", High=None), price(5, 7.0, "VOD.L", Low=None),
            price(None, 7.0, "VOD.L"), price(6, 7.0, None), price(7, 3.0, "A.B.C", Volume=None),
        ],
        PRICE,
    )
    kept = rows(prices_cleaned(bronze).select("ticker", "price_date", "close_price"))
    assert [tuple(r.values()) for r in kept] == [
        ("A_B_C", date(2026, 7, 7), 3.0), ("EURUSD", date(2026, 7, 1), 1.08), ("VOD_L", date(2026, 7, 1), 712.5)
    ]


def test_suffix_is_only_stripped_at_the_end(spark):
    bronze = spark.createDataFrame([price(1, 1.0, "X=XY=X")], PRICE)
    assert prices_cleaned(bronze).first().ticker == "X=XY"


def test_newest_load_of_a_price_wins(spark):
    bronze = spark.createDataFrame([price(1, 50.0, "NVO", 2), price(1, 49.0, "NVO", 1), price(1, 48.0, "NVO", 0)], PRICE)
    cleaned = prices_cleaned(bronze)
    assert [(r.close_price, r.fetched_at) for r in cleaned.collect()] == [(50.0, "load-2")]
    assert cleaned.columns == [
        "price_date", "open_price", "high_price", "low_price", "close_price", "volume", "ticker", "fetched_at"
    ]


TRADE = (
    "trade_id string, desk string, book_id string, trader_id string, counterparty string, asset_class string, "
    "instrument_type string, ticker string, isin string, cusip string, direction string, notional double, "
    "currency string, trade_date date, maturity_date date, generated_at string"
)


def trade(trade_id="EQ-1", direction="LONG", notional=500_000.0, currency="USD", ticker="NVO", stamp="2026-08-01"):
    return (
        trade_id, "Equity Desk", "B", "T", "Bank", "Equity", "EQUITY", ticker, None, None, direction, notional,
        currency, date(2026, 1, 5), date(2026, 8, 13), stamp,
    )


@pytest.fixture
def enrich(spark, closes, day):
    def run(*trades, rates=(("USD", 1.0), ("EUR", 1.2))):
        fx = spark.createDataFrame(list(rates), "currency string, rate_vs_usd double")
        prices = closes(("NVO", date(2026, 7, 31), 41.0), ("NVO", date(2026, 7, 30), 40.0))
        return positions_enriched(spark.createDataFrame(list(trades), TRADE), fx, prices, day)

    return run


def test_long_usd_position(enrich):
    r = enrich(trade()).first()
    assert (r.fx_rate_vs_usd, r.notional_usd, r.direction_multiplier, r.net_exposure_usd) == (1.0, 5e5, 1, 5e5)
    assert (r.current_price, r.latest_price_date, r.market_value_usd) == (41.0, date(2026, 7, 31), 41.0)
    assert r.days_to_maturity == 10


def test_short_foreign_position(enrich):
    r = enrich(trade("FX-1", "SHORT", 3_000_000.0, "eur")).first()
    assert r.currency == "EUR" and r.notional_usd == pytest.approx(3.6e6)
    assert r.direction_multiplier == -1 and r.net_exposure_usd == pytest.approx(-3.6e6)


def test_unpriced_ticker_stays_and_missing_rate_drops(enrich):
    out = {r.trade_id: r for r in enrich(trade("A", ticker="???"), trade("B", currency="CHF"), trade("C", "FLAT")).collect()}
    assert set(out) == {"A", "C"}
    assert out["A"].current_price is None and out["A"].market_value_usd == 5e5
    assert out["C"].direction_multiplier == 0 and out["C"].net_exposure_usd == 0.0


def test_newest_snapshot_of_a_trade_wins(enrich):
    out = enrich(trade(notional=1.0, stamp="2026-08-01"), trade(notional=2.0, stamp="2026-08-02"), trade(None)).collect()
    assert [(r.trade_id, r.notional) for r in out] == [("EQ-1", 2.0)]


def test_rates_listed_twice_do_not_double_positions(spark):
    fx = spark.createDataFrame(
        [("EUR", 1.1, date(2026, 8, 1)), ("eur", 1.2, date(2026, 8, 2)), ("USD", 1.0, date(2026, 8, 1))],
        "currency string, rate_vs_usd double, as_of_date date",
    )
    assert {r.currency: r.fx_rate_vs_usd for r in latest_rates(fx).collect()} == {"EUR": 1.2, "USD": 1.0}


def test_silver_equals_without_prices(enrich, spark, day):
    fx = spark.createDataFrame([("USD", 1.0)], "currency string, rate_vs_usd double")
    bare = positions_enriched(spark.createDataFrame([trade()], TRADE), fx, None, day)
    assert bare.columns == enrich(trade()).columns
    assert bare.select(F.col("notional_usd")).first()[0] == 5e5
