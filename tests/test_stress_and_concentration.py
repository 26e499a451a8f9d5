import random
from datetime import date

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from table_rows import rows

from deskrisk.operators import rank_rows, settle
from deskrisk.plans.concentration import concentration_risk
from deskrisk.plans.stress import stress_testing

SCENARIO = (
    "scenario_name string, asset_class string, shock_pct double, shock_bps double, scenario_type string, "
    "is_stressed_var_proxy boolean"
)


@pytest.fixture
def stress(spark, day):
    def run(positions, *shocks, var=((20.0, "FX"), (30.0, "Rates")), limit=500.0):
        v = spark.createDataFrame(
            [(date(2026, 8, 3), "FX Desk", c, x) for x, c in var] + [(date(2026, 8, 1), "FX Desk", "FX", 1e9)],
            "calculation_date date, desk string, asset_class string, var_99_usd double",
        )
        lines = spark.createDataFrame([("FX DESK", limit, date(2026, 1, 1))], "desk string, limit_usd double, approved_date date")
        scenarios = spark.createDataFrame(list(shocks), SCENARIO)
        return rows(stress_testing(positions, scenarios, v, lines, day), "desk", "scenario_name")

    return run


def test_shocks_by_kind_and_worst_class(book, stress):
    positions = book(
        {"notional_usd": 1000.0}, {"notional_usd": 200.0, "direction": "SHORT"},
        {"asset_class": "Rates", "notional_usd": 100.0, "days_to_maturity": 3650},
        {"asset_class": "RATES", "notional_usd": 50.0, "days_to_maturity": -4},
        {"asset_class": "Equity", "notional_usd": 650.0}, {"desk": "Other", "asset_class": "Equity"},
    )
    (s,) = stress(
        positions, ("Shock", "fx", -0.1, None, "REGULATORY", False), ("Shock", "Rates", None, 200.0, "REGULATORY", True),
    )
    assert s["stressed_pnl_fx_usd"] == pytest.approx(-80.0)
    assert s["stressed_pnl_rates_usd"] == pytest.approx(-20.0)  # long bonds lose when yields rise
    assert (s["stressed_pnl_equity_usd"], s["stressed_pnl_credit_usd"]) == (0.0, 0.0)
    assert s["stressed_pnl_usd"] == pytest.approx(-100.0)
    assert (s["worst_asset_class"], s["worst_asset_class_pnl_usd"]) == ("FX", pytest.approx(-80.0))
    assert s["position_count"] == 4 and s["is_stressed_var_proxy"] is True
    assert s["total_notional_usd"] == 1350.0 and s["portfolio_total_notional_usd"] == 2100.0
    assert s["coverage_pct"] == pytest.approx(64.2857)
    assert s["var_99_usd"] == 50.0 and s["stressed_loss_to_var_ratio"] == 2.0
    assert s["desk_limit_usd"] == 500.0 and s["stressed_loss_to_limit_pct"] == 20.0


def test_ratios_are_guarded_and_empty_shock_is_zero(book, stress):
    (s,) = stress(book({}), ("None", "FX", None, None, "MANAGEMENT", False), var=(), limit=0.0)
    assert s["stressed_pnl_usd"] == 0.0 and s["stressed_loss_to_limit_pct"] is None
    assert s["var_99_usd"] is None and s["stressed_loss_to_var_ratio"] is None


@pytest.fixture(scope="module")
def crowded():
    """One counterparty holds a third of the trades."""
    rng = random.Random(11)
    return [
        {
            "trade_id": f"T{i}", "desk": rng.choice(("FX Desk", "Rates Desk", "Macro Desk")),
            "asset_class": rng.choice(("FX", "Equity")), "ticker": rng.choice("abcdefg"),
            "counterparty": rng.choice(("Hub", "Hub", "Hub", "B1", "B2", "B3", "B4", "B5", "B6")),
            "direction": rng.choice(("LONG", "SHORT")), "notional_usd": float(rng.randint(1, 900)),
            "days_to_maturity": rng.choice((None, -3, 40, 365, 366, 2000, 5000)),
        }
        for i in range(240)
    ]


@pytest.fixture(scope="module")
def classes(spark):
    return spark.createDataFrame(
        [("A", "Tech", "US"), ("b", "Tech", "UK"), ("C", "Food", "US")], "ticker string, sector string, geography string"
    )


def test_concentration_equals_brute_force(book, crowded, classes, day):
    out = pd.DataFrame(rows(concentration_risk(book(*crowded), classes, day)))
    frame = pd.DataFrame(crowded)
    known = {"a": ("Tech", "US"), "b": ("Tech", "UK"), "c": ("Food", "US")}
    frame["sector"] = [known.get(t, ("Unknown",) * 2)[0] for t in frame["ticker"]]
    frame["geography"] = [known.get(t, ("Unknown",) * 2)[1] for t in frame["ticker"]]
    frame["bucket"] = [
        "0-1Y" if pd.isna(d) or d <= 365 else "1-5Y" if d <= 1825 else "5-10Y" if d <= 3650 else "10Y+"
        for d in frame["days_to_maturity"]
    ]
    frame["net"] = frame["notional_usd"] * frame["direction"].map({"LONG": 1, "SHORT": -1})
    desk_total = frame.groupby("desk")["notional_usd"].sum()
    total = frame["notional_usd"].sum()
    kinds = {
        "COUNTERPARTY": "counterparty", "INSTRUMENT": "ticker", "SECTOR": "sector", "GEOGRAPHY": "geography",
        "ASSET_CLASS": "asset_class", "MATURITY_BUCKET": "bucket",
    }
    assert set(out["concentration_type"]) == set(kinds)
    for kind, column in kinds.items():
        want = frame.groupby(["desk", column]).agg(n=("trade_id", "nunique"), gross=("notional_usd", "sum"), net=("net", "sum"))
        have = out[out["concentration_type"] == kind].set_index(["desk", "entity_name"])
        assert len(have) == len(want)
        for (desk, entity), w in want.iterrows():
            h = have.loc[(desk, entity)]
            assert (h["position_count"], h["gross_exposure_usd"], h["net_exposure_usd"]) == (w["n"], w["gross"], w["net"])
            assert h["net_abs_exposure_usd"] == abs(w["net"])
            assert h["pct_of_desk_total"] == pytest.approx(w["gross"] / desk_total[desk] * 100, abs=6e-5)
            assert h["pct_of_portfolio_total"] == pytest.approx(w["gross"] / total * 100, abs=6e-5)
        for desk, group in have.groupby(level=0):
            assert group["pct_of_desk_total"].sum() == pytest.approx(100, abs=0.01)
            assert group["desk_hhi"].iloc[0] == pytest.approx((group["pct_of_desk_total"] ** 2).sum(), abs=0.006)
            ranked = group.reset_index().sort_values(["gross_exposure_usd", "entity_name"], ascending=[False, True])
            assert list(ranked["desk_rank"]) == list(range(1, len(group) + 1))
        ranked = have.reset_index().sort_values(["gross_exposure_usd", "desk", "entity_name"], ascending=[False, True, True])
        assert list(ranked["portfolio_rank"]) == list(range(1, len(have) + 1))
    share, of_desk = out["pct_of_portfolio_total"], out["pct_of_desk_total"]
    assert list(out["large_exposure_flag"]) == list(share > 25)
    assert list(out["concentration_level"]) == ["HIGH" if s > 10 else "MEDIUM" if s > 5 else "LOW" for s in share]
    assert list(out["desk_concentration_level"]) == ["HIGH" if s > 20 else "MEDIUM" if s > 10 else "LOW" for s in of_desk]


@pytest.mark.parametrize("seed", [2, 5, 64])
def test_ranges_give_the_plain_row_number(spark, seed):
    """With ties by the hundred, NULL values, NULL keys and a group of a third of the rows."""
    rng = random.Random(seed)
    lines = [
        (rng.choice(("hot", "hot", "cold", None)), rng.choice((None, 1.0, 1.0, 2.5, rng.random(), -3.0)), i)
        for i in range(900)
    ]
    df = settle(spark.createDataFrame(lines, "k string, v double, i int"), "ranks")
    plain = F.row_number().over(Window.partitionBy("k").orderBy(F.desc("v"), "i"))
    assert rows(rank_rows(df, ["k"], "v", ["i"], "n"), "i") == rows(df.withColumn("n", plain), "i")


def test_equal_values_are_spread_over_ranges(spark):
    df = spark.range(2000).select(F.lit("k").alias("k"), F.lit(1.0).alias("v"), F.col("id").alias("i"))
    order = [F.desc("v"), F.asc("i")]
    sizes = df.repartitionByRange(4, F.asc("k"), *order).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 4
    assert [r.n for r in rank_rows(df, ["k"], "v", ["i"], "n").orderBy("i").collect()] == list(range(1, 2001))
