import os
import sys
from datetime import date

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from deskrisk.operators.scratch import scratch_of_run  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.maxMetadataStringLength", "10000")
        .config("spark.sql.debug.maxToStringFields", "1000")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="module", autouse=True)
def scratch(spark):
    """What a module settles goes with it, so that no other finds it in the scratch folder they share."""
    with scratch_of_run(spark):
        yield


@pytest.fixture(scope="session")
def day():
    return F.lit(date(2026, 8, 3))


SIDE = {"LONG": 1, "SHORT": -1}
POSITION = (
    "trade_id string, desk string, asset_class string, ticker string, counterparty string, direction string, "
    "currency string, notional_usd double, net_exposure_usd double, direction_multiplier int, "
    "days_to_maturity int, fx_rate_vs_usd double, current_price double, latest_price_date date"
)


@pytest.fixture(scope="session")
def book(spark):
    """Enriched positions from short dicts; what a test does not name gets a default."""

    def build(*rows):
        full = []
        for i, r in enumerate(rows):
            side = SIDE.get(r.get("direction", "LONG"), 0)
            notional = float(r.get("notional_usd", 100.0))
            full.append(
                (
                    r.get("trade_id", f"T{i}"), r.get("desk", "FX Desk"), r.get("asset_class", "FX"),
                    r.get("ticker", "AAA"), r.get("counterparty", "Bank"), r.get("direction", "LONG"),
                    r.get("currency", "EUR"), notional, notional * side, side, r.get("days_to_maturity", 100),
                    r.get("fx_rate_vs_usd", 1.0), r.get("current_price"), r.get("latest_price_date"),
                )
            )
        return spark.createDataFrame(full, POSITION)

    return build


@pytest.fixture(scope="session")
def closes(spark):
    """Cleaned prices from (ticker, day, close)."""

    def build(*rows):
        return spark.createDataFrame(list(rows), "ticker string, price_date date, close_price double")

    return build
