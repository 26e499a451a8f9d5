"""A small firm's daily runs from bronze to checked gold."""

import os
import random
from datetime import date, datetime, timedelta

import pytest
from table_rows import rows
from pyspark.sql import functions as F

from deskrisk.operators.checks import QualityError
from deskrisk.plans.gates import DESK_CLASS
from deskrisk.plans.pipeline import load_bronze, run
from deskrisk.serving import reports
from deskrisk.sources.lake import Lake
from deskrisk.sources.schemas import BRONZE, GOLD, KEYS, SEEDS, TABLES

FIRST = date(2025, 1, 1)
DAYS = 440
RUN = FIRST + timedelta(days=DAYS - 1)
LOADED = datetime(2026, 3, 1)
TICKERS = ("EURUSD=X", "NVO", "VOD.L")


def fill(lake, bad_price=False):
    spark, rng = lake.spark, random.Random(1)
    prices, trades = [], []
    for t in TICKERS:
        level = 50.0
        for i in range(DAYS):
            level *= 1 + rng.uniform(-0.03, 0.03)
            prices.append((FIRST + timedelta(days=i), level, level, level, level, 1.0, t, "f", "src", LOADED))
    if bad_price:
        prices.append((RUN, 1.0, 1.0, 1.0, -1.0, 1.0, "BAD", "f", "src", LOADED))
    products = {"FX": "FX_FORWARD", "Equity": "EQUITY", "Rates": "CORPORATE_BOND", "Credit": "CDS"}
    for i in range(80):
        desk, asset_class = list(DESK_CLASS.items())[i % 4]
        trades.append(
            (
                f"T{i}", desk, "BOOK", "TR", rng.choice(("Bank A", "Bank B")), asset_class, products[asset_class],
                rng.choice(("EURUSD", "NVO", "VOD_L")), None, None, rng.choice(("LONG", "SHORT")),
                rng.uniform(1e4, 1e6), rng.choice(("USD", "EUR")), FIRST, RUN + timedelta(days=rng.randint(-30, 4000)),
                "2026-03-01", "src", LOADED,
            )
        )
    data = {
        "market_prices": prices,
        "positions": trades + trades[:10],  # ten trades loaded twice
        "fx_rates": [(c, r, FIRST, "g", "src", LOADED) for c, r in (("USD", 1.0), ("EUR", 1.1))] * 2,
        "desk_limits": [
            (d, 9e7 if d != "FX Desk" else 1e5, "USD", FIRST, RUN, "a", "u", FIRST, "", "src", LOADED) for d in DESK_CLASS
        ],
    }
    for table, lines in data.items():
        spark.createDataFrame(lines, BRONZE[table]).write.mode("overwrite").parquet(lake.path(table))
    seeds = {
        "stress_scenarios": [("Crash", "Equity", -0.3, None, "REGULATORY", True), ("Crash", "Rates", None, 200.0, "REGULATORY", True)],
        "ticker_classifications": [("NVO", "Health", "Europe")],
    }
    for table, lines in seeds.items():
        spark.createDataFrame(lines, SEEDS[table]).write.mode("overwrite").parquet(lake.path(table))


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    lake = Lake(spark, str(tmp_path_factory.mktemp("lake")))
    fill(lake)
    run(lake, RUN)
    return lake


def snapshot(lake):
    return {t: rows(lake.read(t).select(*[c for c in GOLD[t].names if c != "_gold_loaded_at"])) for t in KEYS}


def test_all_tables_are_filled_and_typed(lake):
    for table in KEYS:
        df = lake.read(table)
        assert not df.isEmpty(), table
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in TABLES[table]]
        assert df.where(F.col("_gold_loaded_at").isNull()).isEmpty()
    assert lake.read("positions_enriched").count() == 80
    health = reports.lake_health(lake)
    assert health.count() == 23 and health.where("row_count IS NULL OR row_count = 0").isEmpty()


def test_summary_agrees_with_its_sources(lake):
    summary = {r["desk"]: r for r in rows(lake.read("risk_summary"))}
    assert set(summary) == set(DESK_CLASS)
    var = {r.desk: r.v for r in lake.read("var_daily").groupBy("desk").agg(F.sum("var_99_usd").alias("v")).collect()}
    for desk, r in summary.items():
        assert r["var_99_usd"] == pytest.approx(var[desk]) and r["largest_counterparty"] in ("Bank A", "Bank B")
    assert summary["FX Desk"]["limit_status"] == "RED" == summary["FX Desk"]["overall_risk_status"]
    assert summary["FX Desk"]["worst_stress_scenario"] is None  # no scenario shocks its class


def test_repeating_a_day_changes_nothing_and_a_new_day_adds(lake):
    before = snapshot(lake)
    run(lake, RUN)
    assert snapshot(lake) == before
    run(lake, RUN + timedelta(days=1))
    after = snapshot(lake)
    for table in KEYS:
        if table != "limit_breach_log":
            assert all(r in after[table] for r in before[table]), table
            assert len(after[table]) == 2 * len(before[table]), table
    (breach,) = after["limit_breach_log"]
    assert breach["is_active"] and breach["breach_duration_days"] == 1 and breach["breach_start_date"] == RUN


def test_a_failing_gate_stops_before_gold(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    fill(lake, bad_price=True)
    with pytest.raises(QualityError, match="non_positive_close_price: 1"):
        run(lake, RUN)
    assert lake.find("var_daily") is None


def test_landing_zone_to_gold(spark, tmp_path):
    """CSV files in; a second day brings new files, and the old ones are not loaded again."""
    root = tmp_path / "landing"
    source = Lake(spark, str(tmp_path / "source"))
    fill(source)

    def csv(table, path):
        df = source.read(table).drop("_source_file", "_ingested_at")
        path.parent.mkdir(parents=True, exist_ok=True)
        df.toPandas().to_csv(path, index=False)

    csv("market_prices", root / "prices" / "year=2026" / "month=03" / "day=01" / "all.csv")
    csv("positions", root / "positions" / "year=2026" / "month=03" / "day=01" / "positions.csv")
    csv("fx_rates", root / "reference" / "fx_rates.csv")
    csv("desk_limits", root / "reference" / "desk_limits.csv")
    for seed in SEEDS:
        csv(seed, root / "seeds" / f"{seed}.csv")
    lake = Lake(spark, str(tmp_path / "lake"))
    for _ in range(2):
        load_bronze(lake, str(root), str(tmp_path / "progress"))
    counts = {t: (lake.read(t).count(), source.read(t).count()) for t in (*BRONZE, *SEEDS)}
    assert counts.pop("fx_rates") == (8, 4)  # appended on every run
    assert all(have == want for have, want in counts.values()), counts
    run(lake, RUN)
    run(source, RUN)
    for table in KEYS:
        drop = [c for c in GOLD[table].names if c != "_gold_loaded_at"]
        have, want = rows(lake.read(table).select(*drop)), rows(source.read(table).select(*drop))
        for a, b in zip(have, want, strict=True):
            for c in a:
                assert a[c] == (pytest.approx(b[c]) if isinstance(b[c], float) else b[c]), (table, c)
    scratch = spark.conf.get("spark.checkpoint.dir")
    assert not [p for p in os.listdir(scratch) if "-book-" in p or "-exposure-cube-" in p]
