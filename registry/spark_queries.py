"""Each registered query as a function of (session, folder with the sample tables)."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from deskrisk.functions import normalise_ticker, trade_noise
from deskrisk.operators import checks, merge_frames, merge_into, settle
from deskrisk.operators import schema_guard as guard
from deskrisk.operators.scratch import drop_folder, released_shuffles, scratch_dir, scratch_of_run
from deskrisk.operators.upsert import SchemaDriftError
from deskrisk.plans import gates, incremental
from deskrisk.plans.exposure import breach_log_step as step_breaches
from deskrisk.plans.sample_gold import SampleGold
from deskrisk.plans.silver import enrich
from deskrisk.plans.value_at_risk import backtest_step as step_backtest
from deskrisk.plans.value_at_risk import backtest_window, var_backtest
from deskrisk.serving import reports
from deskrisk.serving.charts import CHARTS, chart_query
from deskrisk.sources import landing
from deskrisk.sources.lake import Lake
from deskrisk.sources.sample import DESKS, RUN_DATE, Sample
from deskrisk.sources.schemas import BRONZE, DATED, KEYS, SILVER, TABLES, business_columns
from deskrisk.sources.seeds import read_seed
from deskrisk.sources.versions import current_folder
from deskrisk.streaming.ingest import ingest_evolving, ingest_incremental, read_ingested, read_rejects
from registry import outputs
from registry.duckdb_queries import GIVEN_TABLES

Query = Callable[[SparkSession, str], DataFrame]
RUN_DAY = date.fromisoformat(RUN_DATE)

QUERIES: dict[str, Query] = {}


def _sample(spark: SparkSession, folder: str) -> Sample:
    """The sample's tables are one file each, so the big one is spread over tasks."""
    return Sample(spark, folder, spread=True)


def query(function: Callable[[Sample], DataFrame]) -> Callable[[Sample], DataFrame]:
    QUERIES[function.__name__] = lambda spark, folder: function(_sample(spark, folder))
    return function


def rounded(df: DataFrame, places: dict[str, int]) -> DataFrame:
    return df.withColumns({c: F.round(c, n) for c, n in places.items()})


def folder_for(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/deskrisk-{name}-{uuid.uuid4().hex}"


# -------------------------------------------------------------------------- silver


@query
def prices_cleaned(s: Sample) -> DataFrame:
    return s.prices_cleaned


@query
def positions_enriched(s: Sample) -> DataFrame:
    return s.positions_enriched


# ---------------------------------------------------------------------------- gold


def _gold(table: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return rounded(getattr(SampleGold(_sample(spark, folder)), table), outputs.places(table))

    return run


for _table in KEYS:
    QUERIES[_table] = _gold(_table)


def _chart(name: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        chart = CHARTS[name]
        table = getattr(SampleGold(_sample(spark, folder)), chart.source)
        span = {}
        if name == "ch01_risk_status":
            span = {"date_col": DATED[chart.source], "start": RUN_DAY, "end": RUN_DAY + timedelta(days=1)}
        return rounded(chart_query(table, chart, **span), outputs.chart_places(name))

    return run


for _name in CHARTS:
    QUERIES[_name] = _chart(_name)


# ------------------------------------------------------------------------ ingestion


@query
def normalise_market_data(s: Sample) -> DataFrame:
    raw = s.market_prices.select(
        "Date", "Open", "High", "Low", "Close",
        F.when(F.col("Volume") == 1, 0.0).otherwise(F.col("Volume")).alias("Volume"),
        F.col("ticker").alias("_symbol"), F.col("fetched_at").alias("_stamp"),
    )
    return landing.normalise_market_data(raw, F.col("_symbol"), F.col("_stamp"))


@query
def fx_rates_from_prices(s: Sample) -> DataFrame:
    currency = (
        F.when(F.col("r_name") == "ASIA", "JPY").when(F.col("r_name") == "EUROPE", "EUR")
        .when(F.col("r_name") == "MIDDLE EAST", "GBP").when(F.col("r_name") == "AMERICA", "AUD").otherwise("SGD")
    )
    pairs = (
        s.table("orders")
        .join(s.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(s.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(s.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy(F.concat(currency, F.lit("USD=X")).alias("ticker"), F.col("o_orderdate").cast("date").alias("date"))
        .agg((F.max("o_totalprice") / 300000.0).alias("close"))
    )
    return landing.fx_rates_from_prices(pairs, s.run_date)


def _landed_prices(s: Sample) -> tuple[str, StructType]:
    """Market prices written to a landing zone, one folder per month of fetching."""
    schema = StructType(BRONZE["market_prices"].fields[:8])
    folder = folder_for(s.spark, "landing")
    rows = s.market_prices.select(*schema.names, F.to_date("fetched_at", "yyyy-MM").alias("run_date"))
    landing.write_landing(rows, folder, "run_date")
    return folder, schema


def _by_ticker(df: DataFrame) -> DataFrame:
    return df.groupBy("ticker", "fetched_at").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("Date").alias("first_date"),
        F.max("Close").alias("highest_close"),
        F.count_if(F.col("_source_file").isNull()).alias("without_file"),
    )


@query
def read_landing(s: Sample) -> DataFrame:
    folder, schema = _landed_prices(s)
    return _by_ticker(landing.read_landing(s.spark, folder, schema))


@query
def ingest_incremental_files(s: Sample) -> DataFrame:
    """Loaded twice over the same landing zone: the second run adds nothing."""
    folder, schema = _landed_prices(s)
    table, checkpoint = folder_for(s.spark, "bronze"), folder_for(s.spark, "progress")
    for _ in range(2):
        ingest_incremental(s.spark, folder, schema, table, checkpoint)
    return _by_ticker(read_ingested(s.spark, table))


_CLOSES = StructType([f for f in BRONZE["market_prices"] if f.name in ("Date", "Close", "ticker")])


@query
def ingest_evolving_files(s: Sample) -> DataFrame:
    """A first batch without volumes, a second one with them and in another order."""
    folder, table, checkpoint = (folder_for(s.spark, n) for n in ("landing", "bronze", "progress"))
    day = F.to_date("fetched_at", "yyyy-MM").alias("run_date")
    rows = s.market_prices.select("Date", "Close", "ticker", "Volume", day)
    early = F.col("run_date") < F.lit("1995-07-01").cast("date")
    for part in (rows.where(early).drop("Volume"), rows.where(~early).select("Volume", "ticker", "Close", "Date", "run_date")):
        landing.write_landing(part, folder, "run_date")
        ingest_evolving(s.spark, folder, _CLOSES, table, checkpoint)
    return read_ingested(s.spark, table).groupBy("ticker").agg(
        F.count(F.lit(1)).alias("row_count"), F.count("Close").alias("closes"),
        F.count("Volume").alias("volumes"), F.sum(F.col("Volume").cast("double")).alias("volume"),
    )


@query
def landing_rejects(s: Sample) -> DataFrame:
    """Rows of volume 1 have a field too many, rows of volume 2 one too few."""
    folder, table, checkpoint = (folder_for(s.spark, n) for n in ("landing", "bronze", "progress"))
    fields = [F.col("ticker"), F.col("Date").cast("string")]
    close = F.coalesce(F.col("Close").cast("string"), F.lit(""))
    line = (
        F.when(F.col("Volume") == 1, F.concat_ws(",", *fields, close, F.lit("EXTRA")))
        .when(F.col("Volume") == 2, F.concat_ws(",", *fields))
        .otherwise(F.concat_ws(",", *fields, close))
    )
    lines = s.market_prices.select(line.alias("ticker,Date,Close"))
    lines.write.option("header", True).option("quote", "").option("sep", "\u0001").csv(folder)
    ingest_incremental(s.spark, folder, _CLOSES, table, checkpoint, pattern="*.csv")
    loaded = read_ingested(s.spark, table).select("ticker", F.lit(0).alias("reject"))
    rejects = read_rejects(s.spark, table).select(F.split_part("text", F.lit(","), F.lit(1)).alias("ticker"), F.lit(1).alias("reject"))
    return loaded.unionByName(rejects).groupBy("ticker").agg(
        F.count_if(F.col("reject") == 0).alias("loaded"), F.count_if(F.col("reject") == 1).alias("rejected")
    )


@query
def reload_forced(s: Sample) -> DataFrame:
    """Loaded twice with append: every row is there twice."""
    table = folder_for(s.spark, "bronze")
    rows = s.desk_limits
    landing.append(rows, table)
    landing.append(rows, table)
    return s.spark.read.parquet(table).select("desk", F.round("limit_usd", 2).alias("limit_usd"), "approved_date")


@query
def truncate_reload(s: Sample) -> DataFrame:
    table = folder_for(s.spark, "bronze")
    first = s.positions.select("trade_id", "desk", "notional")
    landing.truncate_reload(first, table)
    landing.truncate_reload(first.withColumn("notional", F.col("notional") * 2), table)
    return s.spark.read.parquet(current_folder(s.spark, table))


@query
def full_refresh(s: Sample) -> DataFrame:
    """Refreshed twice; a load without rows in between leaves the table as it is."""
    table = folder_for(s.spark, "bronze")
    trades = s.positions.select("trade_id", "desk", "notional")
    landing.full_refresh(trades, table)
    try:
        landing.truncate_reload(trades.where("desk IS NULL"), table)
    except landing.EmptyLoadError:
        held = s.spark.read.parquet(current_folder(s.spark, table))
        landing.full_refresh(held.withColumn("notional", F.col("notional") * 3), table)
    return s.spark.read.parquet(current_folder(s.spark, table))


@query
def read_required(s: Sample) -> DataFrame:
    """Limits from a file whose columns are in another order than declared."""
    schema, folder = BRONZE["desk_limits"], folder_for(s.spark, "limits")
    rows = s.desk_limits
    lacking = {f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in (*rows.columns, *landing.AUDIT)}
    rows.withColumns(lacking).select(*reversed([f.name for f in schema if f.name not in landing.AUDIT])).write.option("header", True).csv(folder)
    loaded = landing.read_required(s.spark, folder, schema)
    return loaded.select("desk", F.round("limit_usd", 2).alias("limit_usd"), "approved_date")


@query
def landing_inventory(s: Sample) -> DataFrame:
    """Folders of the landing zone that hold files, and whether any is empty."""
    folder, _ = _landed_prices(s)
    files = landing.landing_inventory(s.spark, folder, "year=").where(F.col("filename").endswith(".csv"))
    return files.groupBy(F.regexp_extract("filename", "^(.*)/", 1).alias("folder")).agg(
        F.count_if(F.col("last_modified").isNull()).alias("undated")
    )


# ----------------------------------------------------------------- declared tables


@query
def table_schemas(s: Sample) -> DataFrame:
    """Declared type of each column of the two large bronze tables, and its values that are not NULL."""
    parts = []
    for name, rows in (("market_prices", s.market_prices), ("positions", s.positions)):
        fields = [f for f in TABLES[name] if f.name in rows.columns]
        typed = rows.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in fields])
        counts = typed.agg(*[F.count(f.name).alias(f.name) for f in fields])
        lines = [F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("type"), F.col(f.name).alias("values")) for f in fields]
        parts.append(counts.select(F.lit(name).alias("table_name"), F.inline(F.array(*lines))))
    return parts[0].unionByName(parts[1])


@query
def schema_guard(s: Sample) -> DataFrame:
    """Trades by desk behind the guard, which puts columns in order, and how many drifted variants it refused."""
    held, schema = s.positions_enriched, StructType(SILVER["positions_enriched"].fields[:-1])
    guarded = guard(held.select(*reversed(held.columns)), schema)
    refused = 0
    for drifted in (held.drop("notional"), held.withColumn("extra", F.lit(1)), held.withColumn("notional", F.col("notional").cast("string"))):
        try:
            guard(drifted, schema)
        except SchemaDriftError:
            refused += 1
    return guarded.groupBy("desk").agg(F.count(F.lit(1)).alias("trades"), F.lit(refused).alias("refused"))


@query
def noise_hash(s: Sample) -> DataFrame:
    """The engine's own hash as noise: how many load rows of a desk stay within a hundredth of one."""
    noise = trade_noise(F.col("trade_id"))
    return s.positions.groupBy("desk").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(noise.between(0.9901, 1.0099)).alias("within")
    )


# --------------------------------------------------------------------- incremental


def _lake(s: Sample) -> Lake:
    return Lake(s.spark, folder_for(s.spark, "lake"))


def _land(s: Sample, lake: Lake, table: str, rows: DataFrame, part: str) -> None:
    """One more landing file set for ``table``, ingested and then removed, as the table holds its rows."""
    folder = f"{lake.root}/landing/{table}"
    rows.write.option("header", True).csv(f"{folder}/{part}")
    ingest_evolving(s.spark, folder, BRONZE[table], lake.path(table), f"{lake.root}/progress/{table}", pattern="*/*.csv")
    drop_folder(s.spark, f"{folder}/{part}")


@query
def prices_incremental(s: Sample) -> DataFrame:
    """Prices up to 1997 at twice their value, then all from mid-1996 on as they are; each load merged alone."""
    lake, names = _lake(s), [f.name for f in BRONZE["market_prices"] if f.name not in landing.AUDIT]
    cleaned = settle(s.prices_cleaned, "cleaned")
    vendor = cleaned.select("price_date", *[f"{k}_price" for k in ("open", "high", "low", "close")], "volume", "ticker", "fetched_at").toDF(*names)
    doubled = vendor.withColumns({k: F.col(k) * 2 for k in ("Open", "High", "Low", "Close")})
    for part, rows in (("a", doubled.where("Date < '1997-01-01'")), ("b", vendor.where("Date >= '1996-06-10'"))):
        _land(s, lake, "market_prices", rows, part)
        incremental.take_prices(lake)
    closes = incremental.newest_closes(lake.read("month_closes"))
    return lake.read("prices_cleaned").join(closes, "ticker").select("price_date", "ticker", "close_price", "volume", "current_price", "latest_price_date")


@query
def trades_incremental(s: Sample) -> DataFrame:
    """All trades, then half of them again with a newer stamp, the rest with an older one: only the newer count."""
    lake, names = _lake(s), [f.name for f in BRONZE["positions"] if f.name not in landing.AUDIT]
    even = F.substring("trade_id", -1, 1).isin("0", "2", "4", "6", "8")
    with released_shuffles(s.spark):
        with scratch_of_run(s.spark):
            held = settle(s.positions_unpriced, "trades").withColumn("generated_at", F.lit("2001-06-01"))
            lacking = {n: F.lit(None).cast("string") for n in names if n not in held.columns}
            trades = held.withColumns(lacking).select(*names)
            again = trades.withColumns(
                {"notional": F.col("notional") * 2, "generated_at": F.when(even, "2001-07-01").otherwise("2001-05-01")}
            )
            _land(s, lake, "positions", trades, "a")
            incremental.take_trades(lake, buckets=8)
            _land(s, lake, "positions", again, "b")
        incremental.take_trades(lake, buckets=8)
    rates = s.fx_rates
    enriched = enrich(lake.read("trades_latest"), rates, None, s.run_date)
    return enriched.select("trade_id", "desk", "currency", "notional", "days_to_maturity")


@query
def backtest_step(s: Sample) -> DataFrame:
    """The last day with P&L, from the window of the days before it alone."""
    gold = SampleGold(s)
    history = settle(s.pnl_history(gold.book, gold.prices), "pnl-history")
    var = gold.var_daily.select("desk", "asset_class", "var_97_5_usd")
    last = history.agg(F.max("pnl_date")).scalar()
    days = settle(history.select("desk", F.col("pnl_date").alias("calculation_date")).join(var, "desk"), "var-history")
    before = var_backtest(days.where(F.col("calculation_date") < last), history)
    rows, _ = step_backtest(backtest_window(before), days, history, last)
    return rounded(rows, outputs.places("var_backtest"))


@query
def breach_log_step(s: Sample) -> DataFrame:
    """The breach log of quarterly exposures, stepped from quarter to quarter through a stored table."""
    lake = _lake(s)
    history = settle(s.exposure_history(s.positions_unpriced, "quarter"), "exposure-quarters")
    for day in [r.as_of_date for r in history.select("as_of_date").distinct().orderBy("as_of_date").collect()]:
        lake.merge("limit_breach_log", step_breaches(lake.find("limit_breach_log"), history, F.lit(day)))
    names = business_columns("limit_breach_log")
    return rounded(lake.read("limit_breach_log").select(*names), outputs.places("limit_breach_log"))


@query
def stop_on_fail(s: Sample) -> DataFrame:
    """Prices are replaced behind their rules; a load with a close below zero is refused and leaves them."""
    lake, prices = _lake(s), settle(s.prices_cleaned, "cleaned")
    rules = checks.write_rules(prices, ["ticker", "close_price"], non_positive_close_price=F.col("close_price") <= 0)
    lake.replace("prices_cleaned", prices, rules)
    refused = 0
    try:
        lake.replace("prices_cleaned", prices.withColumn("close_price", -F.col("close_price")), rules)
    except checks.QualityError:
        refused = 1
    return lake.read("prices_cleaned").groupBy("ticker").agg(
        F.count(F.lit(1)).alias("row_count"), F.min("close_price").alias("lowest_close"), F.lit(refused).alias("refused")
    )


@query
def lake_health(s: Sample) -> DataFrame:
    """Tables written in three ways, one whose files are no Parquet, and those not there."""
    lake = _lake(s)
    landing.append(s.positions.select("trade_id", "desk"), lake.path("positions"))
    lake.replace("prices_cleaned", s.prices_cleaned)
    limits = s.desk_limits.select("desk", "limit_usd")
    landing.truncate_reload(limits, lake.path("desk_limits"))
    s.table("region").select("r_name").write.text(lake.path("var_daily"))
    return reports.lake_health(lake)


@query
def evolve_append(s: Sample) -> DataFrame:
    """Old loads without ISIN, new ones with it."""
    table = folder_for(s.spark, "bronze")
    old_days = F.col("trade_date") < F.lit("1998-01-01").cast("date")
    landing.append(s.positions.where(old_days).select("trade_id", "desk", "notional"), table)
    return landing.evolve_append(s.positions.where(~old_days).select("trade_id", "desk", "notional", "isin"), table)


@query
def skip_landed(s: Sample) -> DataFrame:
    """Tickers by day of trading that are planned but have no price yet."""
    key = ["ticker", "day"]
    landed = s.market_prices.select(normalise_ticker(F.col("ticker")).alias("ticker"), F.col("Date").alias("day"))
    planned = s.positions.select("ticker", F.col("trade_date").alias("day")).distinct()
    return landing.skip_landed(planned, landed, key)


@query
def read_seed_file(s: Sample) -> DataFrame:
    """Classifications through a seed CSV; the unclassified region is an empty field."""
    folder = folder_for(s.spark, "seed")
    region = F.when(F.col("geography") != "UK", F.col("geography"))
    s.ticker_classifications.withColumn("geography", region).write.option("header", True).csv(folder)
    return read_seed(s.spark, folder, "ticker_classifications")


# --------------------------------------------------------------------------- upsert


def _history_and_restatement(s: Sample) -> tuple[DataFrame, DataFrame]:
    """Months before 2001, and months from mid-2000 on with other figures."""
    history = settle(
        s.exposure_history(s.positions_unpriced).select("desk", "as_of_date", "gross_exposure_usd", "limit_usd"),
        "exposure-history",
    )
    target = history.where("as_of_date < DATE '2001-01-01'")
    source = history.where("as_of_date >= DATE '2000-06-01'").withColumns(
        {"gross_exposure_usd": F.col("gross_exposure_usd") * 2, "limit_usd": F.col("limit_usd") + 1}
    )
    return target, source


_UPSERT_PLACES = {"gross_exposure_usd": 6, "limit_usd": 6}


@query
def merge_upsert(s: Sample) -> DataFrame:
    target, source = _history_and_restatement(s)
    merged = merge_frames(target, source, ["desk", "as_of_date"], ["gross_exposure_usd"])
    return rounded(merged, _UPSERT_PLACES)


@query
def merge_upsert_table(s: Sample) -> DataFrame:
    """The same through a stored table, merged twice: the second merge changes nothing."""
    target, source = _history_and_restatement(s)
    table = folder_for(s.spark, "gold")
    for rows in (target, source, source):
        merge_into(s.spark, table, rows, ["desk", "as_of_date"], ["gross_exposure_usd"], "as_of_date")
    return rounded(s.spark.read.parquet(table), _UPSERT_PLACES)


# -------------------------------------------------------------------------- quality


@query
def check_not_null(s: Sample) -> DataFrame:
    return checks.run_checks(checks.check_not_null(s.market_prices, c) for c in ("Close", "Open", "ticker"))


@query
def check_unique(s: Sample) -> DataFrame:
    return checks.run_checks(
        [checks.check_unique(s.positions, "trade_id"), checks.check_unique(s.table("orders"), "o_orderkey")]
    )


@query
def check_unique_combination(s: Sample) -> DataFrame:
    return checks.run_checks(
        [
            checks.check_unique_combination(s.table("lineitem"), ["l_orderkey", "l_linenumber"]),
            checks.check_unique_combination(s.prices_cleaned, ["ticker", "price_date"]),
        ]
    )


@query
def check_accepted_values(s: Sample) -> DataFrame:
    return checks.run_checks(
        [
            checks.check_accepted_values(s.positions, "direction", gates.DIRECTIONS),
            checks.check_accepted_values(s.positions, "asset_class", gates.ASSET_CLASSES),
            checks.check_accepted_values(s.positions, "desk", tuple(gates.DESK_CLASS)),
        ]
    )


@query
def column_checks(s: Sample) -> DataFrame:
    return checks.column_checks(
        s.positions, ["trade_id", "isin", "cusip"], {"direction": gates.DIRECTIONS, "currency": ("USD", "EUR")}
    )


@query
def prices_gate(s: Sample) -> DataFrame:
    return gates.prices_gate(s.prices_cleaned)


@query
def positions_gate(s: Sample) -> DataFrame:
    return gates.positions_gate(s.positions_enriched)


@query
def desk_breakdown(s: Sample) -> DataFrame:
    return gates.desk_breakdown(s.positions_unpriced)


@query
def silver_summary(s: Sample) -> DataFrame:
    return gates.silver_summary(s.prices_cleaned, s.positions_unpriced)


@query
def var_gate(s: Sample) -> DataFrame:
    return gates.var_gate(SampleGold(s).var_daily)


@query
def pnl_gate(s: Sample) -> DataFrame:
    return gates.pnl_gate(SampleGold(s).pnl_attribution)


@query
def backtest_gate(s: Sample) -> DataFrame:
    return gates.backtest_gate(SampleGold(s).var_backtest)


@query
def exposure_gate(s: Sample) -> DataFrame:
    return gates.exposure_gate(SampleGold(s).exposure_monitor)


@query
def gold_summary(s: Sample) -> DataFrame:
    gold = SampleGold(s)
    backtest = gold.var_backtest
    tables = {name: (getattr(gold, name), DATED[name]) for name in ("var_daily", "pnl_attribution", "exposure_monitor")}
    return gates.gold_summary({**tables, "var_backtest": (backtest, "backtest_date")})


@query
def bronze_load_audit(s: Sample) -> DataFrame:
    return gates.bronze_load_audit(
        {
            "market_prices": (s.market_prices, "fetched_at"),
            "positions": (s.positions.withColumn("generated_at", F.date_format("generated_at", "yyyy-MM-dd")), "generated_at"),
            "desk_limits": (s.desk_limits, "approved_date"),
        }
    )


@query
def validate_book(s: Sample) -> DataFrame:
    return gates.validate_book(s.positions)


@query
def book_profile(s: Sample) -> DataFrame:
    return gates.book_profile(s.positions)


# -------------------------------------------------------------------------- serving


@query
def var_report(s: Sample) -> DataFrame:
    return rounded(reports.var_report(SampleGold(s).var_daily), {"var_95_usd": 2, "var_99_usd": 2})


@query
def var_report_desk(s: Sample) -> DataFrame:
    return rounded(
        reports.var_report(SampleGold(s).var_daily, "macro desk", DESKS), {"var_95_usd": 2, "var_99_usd": 2}
    )


@query
def active_breaches(s: Sample) -> DataFrame:
    return rounded(
        reports.active_breaches(SampleGold(s).exposure_monitor), {"gross_exposure_usd": 2, "limit_usd": 2}
    )


@query
def pnl_summary(s: Sample) -> DataFrame:
    return reports.pnl_summary(SampleGold(s).pnl_attribution)


@query
def table_health(s: Sample) -> DataFrame:
    return reports.table_health(s.spark, {n: f"{s.folder}/{n}.parquet" for n in GIVEN_TABLES})


@query
def desk_filter(s: Sample) -> DataFrame:
    visible = reports.desk_filter(SampleGold(s).exposure_monitor, ["FX Desk", "Rates Desk"])
    return rounded(visible, outputs.places("exposure_monitor"))


def all_queries() -> dict[str, Query]:
    """By the survey's key names."""
    renamed = {
        "ingest_incremental_files": "ingest_incremental", "ingest_evolving_files": "ingest_evolving",
        "read_seed_file": "read_seed",
    }
    return {renamed.get(name, name): run for name, run in QUERIES.items()}
