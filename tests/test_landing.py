"""Landing files in, bronze rows out: batch, incremental, forced and evolving loads."""

import os
from datetime import date

import pytest
from table_rows import rows
from pyspark.errors import PySparkException
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from deskrisk.functions import padded_id
from deskrisk.operators.files import Files
from deskrisk.sources import landing
from deskrisk.sources.schemas import BRONZE
from deskrisk.sources.seeds import read_seed
from deskrisk.sources.versions import POINTERS, current_folder, replace_table
from deskrisk.streaming.ingest import (
    COMMITS, FeedError, Loaded, ingest_evolving, ingest_incremental, read_ingested, read_rejects,
)

PRICES = BRONZE["market_prices"]
HEADER = "date,open,high,low,close,volume,ticker,fetched_at\n"


def land(root, day, name, *lines, header=HEADER):
    folder = root / "year=2026" / "month=08" / f"day={day:02d}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{name}.csv").write_text(header + "".join(line + "\n" for line in lines))


def test_typed_columns_with_source_and_load_time(spark, tmp_path):
    land(tmp_path, 1, "EURUSD", "2026-08-01,1.1,1.2,1.0,1.15,,EURUSD=X,2026-08-01T10:00")
    land(tmp_path, 2, "NVO", "2026-08-02,5,6,4,5.5,900,NVO,x")
    (tmp_path / "year=2026" / "readme.txt").write_text("not a landing file")
    df = landing.read_landing(spark, str(tmp_path), PRICES)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in PRICES]
    eur, nvo = rows(df, "Date")
    assert (eur["Date"], eur["Close"], eur["Volume"]) == (date(2026, 8, 1), 1.15, None)
    assert nvo["Volume"] == 900.0 and nvo["_source_file"].endswith("day=02/NVO.csv")
    assert nvo["_ingested_at"] is not None


def test_bad_number_stops_the_load(spark, tmp_path):
    land(tmp_path, 1, "A", "2026-08-01,1,1,1,oops,1,A,x")
    with pytest.raises(PySparkException, match="CAST_INVALID_INPUT"):
        landing.read_landing(spark, str(tmp_path), PRICES).collect()


def test_incremental_load_takes_each_file_once(spark, tmp_path):
    zone, table, progress = tmp_path / "zone", str(tmp_path / "bronze"), str(tmp_path / "progress")

    def load(**options):
        return ingest_incremental(spark, str(zone), PRICES, table, progress, **options)

    land(zone, 1, "A", "2026-08-01,1,1,1,1,1,A,x", "2026-08-02,1,1,1,2,1,A,x")
    assert load() == Loaded(2, 0)
    assert load() == Loaded(0, 0)
    land(zone, 2, "B", "2026-08-01,1,1,1,3,1,B,x")
    land(zone, 3, "C", "2026-08-01,1,1,1,4,1,C,x")
    assert load(max_files=1) == Loaded(2, 0)
    loaded = read_ingested(spark, table)
    assert [r["Close"] for r in rows(loaded, "Close")] == [1.0, 2.0, 3.0, 4.0]
    assert loaded.columns == PRICES.names


def test_forced_reload_appends_again(spark, tmp_path):
    table = str(tmp_path / "t")
    for _ in range(2):
        landing.append(spark.range(3), table)
    assert spark.read.parquet(table).count() == 6


def test_truncate_reload_replaces_and_refuses_nothing(spark, tmp_path):
    table = str(tmp_path / "t")
    assert landing.truncate_reload(spark.range(5), table) == 5
    assert landing.truncate_reload(spark.range(2), table) == 2
    with pytest.raises(landing.EmptyLoadError):
        landing.truncate_reload(spark.range(0), table)


def test_full_refresh_leaves_only_the_new_rows(spark, tmp_path):
    table = str(tmp_path / "t")
    landing.full_refresh(spark.range(5), table)
    landing.full_refresh(spark.range(5, 7), table)
    assert [r["id"] for r in rows(spark.read.parquet(current_folder(spark, table)))] == [5, 6]


def test_new_columns_are_admitted_and_changed_types_refused(spark, tmp_path):
    table = str(tmp_path / "t")
    landing.append(spark.range(1).select("id"), table)
    out = landing.evolve_append(spark.range(1, 2).select("id", F.lit("x").alias("note")), table)
    assert rows(out, "id") == [{"id": 0, "note": None}, {"id": 1, "note": "x"}]
    known = landing.evolve_append(spark.range(2, 3).select("id"), table, known=out.schema)
    assert known.columns == ["id", "note"] and known.count() == 3
    with pytest.raises(ValueError, match="id: bigint and string"):
        landing.evolve_append(spark.range(1).select(F.lit("q").alias("id")), table)
    both = landing.evolve(spark.range(1).select("id"), spark.range(1).select(F.lit(2).alias("n")))
    assert both.columns == ["id", "n"]


def test_writing_a_day_replaces_that_day_only(spark, tmp_path):
    folder = str(tmp_path)

    def write(value, *days):
        df = spark.createDataFrame([(date(2026, 1, d), value) for d in days], "run date, v string")
        landing.write_landing(df, folder, "run")

    write("old", 5, 12)
    write("new", 12)
    assert sorted(p.name for p in (tmp_path / "year=2026" / "month=01").iterdir() if p.is_dir()) == ["day=05", "day=12"]
    read = spark.read.option("header", True).csv(f"{folder}/{landing.DATED_GLOB}")
    assert read.columns == ["v"] and sorted(r.v for r in read.collect()) == ["new", "old"]


def test_missing_input_has_its_own_error(spark, tmp_path):
    with pytest.raises(landing.MissingInputError, match="nowhere.csv"):
        landing.read_required(spark, str(tmp_path / "nowhere.csv"), BRONZE["fx_rates"])
    (tmp_path / "fx.csv").write_text("currency,rate_vs_usd,as_of_date,generated_at\nEUR,1.1,2026-08-01,now\n")
    r = landing.read_required(spark, str(tmp_path / "fx.csv"), BRONZE["fx_rates"]).first()
    assert (r.currency, r.rate_vs_usd, r.as_of_date) == ("EUR", 1.1, date(2026, 8, 1))


def test_landed_work_is_skipped_by_path(spark, tmp_path):
    land(tmp_path, 3, "HSBA_L", "x,1,1,1,1,1,HSBA.L,x")
    planned = spark.createDataFrame([("HSBA.L",), ("EURUSD=X",)], "ticker string").select(
        "ticker", landing.landing_path(F.col("ticker"), F.lit(date(2026, 8, 3))).alias("filename")
    )
    landed = landing.landing_inventory(spark, str(tmp_path))
    left = rows(landing.skip_landed(planned, landed, "filename"))
    assert left == [{"filename": "year=2026/month=08/day=03/EURUSD.csv", "ticker": "EURUSD=X"}]


def test_inventory_lists_by_prefix_without_reading(spark, tmp_path):
    land(tmp_path, 1, "A", "x" * 2000)
    land(tmp_path, 2, "B", "y")
    (tmp_path / "other.csv").write_text("z")
    files = landing.landing_inventory(spark, str(tmp_path), "year=2026/month=08/day=01")
    (r,) = files.collect()
    assert r.filename == "year=2026/month=08/day=01/A.csv" and r.size_kb == pytest.approx(2.0) and r.last_modified
    assert landing.landing_inventory(spark, str(tmp_path)).count() == 3
    assert "content" not in files._jdf.queryExecution().executedPlan().toString()


def test_seed_empty_fields_are_null(spark, tmp_path):
    (tmp_path / "s.csv").write_text(
        "scenario_name,asset_class,shock_pct,shock_bps,scenario_type,is_stressed_var_proxy\n"
        "Flood,Equity,-0.2,,REGULATORY,true\nFlood,Rates,,-75,MANAGEMENT,false\n"
    )
    a, b = rows(read_seed(spark, str(tmp_path / "s.csv"), "stress_scenarios"), "asset_class")
    assert (a["shock_pct"], a["shock_bps"], a["is_stressed_var_proxy"]) == (-0.2, None, True)
    assert (b["shock_pct"], b["shock_bps"], b["is_stressed_var_proxy"]) == (None, -75.0, False)


def test_market_data_is_normalised(spark):
    raw = spark.createDataFrame(
        [(date(2026, 8, 1), 1.0, 2.0, 0.5, 1.5, 0)], "Date date, Close double, High double, Low double, Open double, Volume long"
    )
    out = landing.normalise_market_data(raw, F.lit("EURUSD=X"), F.lit("now"))
    assert out.columns == ["date", "open", "high", "low", "close", "volume", "ticker", "fetched_at"]
    assert (out.first().volume, out.first().ticker, out.first().open) == (None, "EURUSD=X", 1.5)
    assert "volume" not in landing.normalise_market_data(raw.drop("Volume"), F.lit("X"), F.lit("")).columns


def test_fx_rates_from_newest_closes(spark):
    prices = spark.createDataFrame(
        [("2026-08-02", 1.23456789, "EURUSD=X"), ("2026-08-01", 9.0, "EURUSD=X"), ("2026-07-31", 0.0067, "JPYUSD")],
        "date string, close double, ticker string",
    )
    out = {r.currency: (r.rate_vs_usd, r.as_of_date) for r in landing.fx_rates_from_prices(prices, F.lit("2026-08-03")).collect()}
    assert out == {
        "EUR": (1.234568, date(2026, 8, 2)), "JPY": (0.0067, date(2026, 7, 31)), "USD": (1.0, date(2026, 8, 3))
    }
    with pytest.raises(landing.EmptyLoadError):
        landing.fx_rates_from_prices(prices.limit(0), F.lit("2026-08-03"))


def test_old_files_are_loaded_and_all_rows_counted(spark, tmp_path):
    """A backfilled file ten days older than the rest, one file per batch, and a short progress memory."""
    root, table, progress = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "p")
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        for day in range(1, 5):
            land(root, day, "A", f"2026-08-0{day},1,1,1,1,1,A,x")
        assert ingest_incremental(spark, str(root), PRICES, table, progress, max_files=1).rows == 4
        land(root, 6, "OLD", "2026-08-06,1,1,1,1,1,A,x")
        path = root / "year=2026" / "month=08" / "day=06" / "OLD.csv"
        old = path.stat().st_mtime - 10 * 86400
        os.utime(path, (old, old))
        assert ingest_incremental(spark, str(root), PRICES, table, progress, max_files=1).rows == 1
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
    assert read_ingested(spark, table).count() == 5


def test_rows_of_another_length_stop_the_load(spark, tmp_path):
    land(tmp_path, 1, "A", "2026-08-01,1,1,1,1,1,A,x,EXTRA")
    with pytest.raises(Exception, match="MALFORMED_CSV_RECORD"):
        landing.read_landing(spark, str(tmp_path), PRICES).collect()


def stored(spark, table):
    return sorted(r.id for r in spark.read.parquet(current_folder(spark, table)).collect())


def test_an_empty_or_failed_reload_keeps_the_old_table(spark, tmp_path):
    table = str(tmp_path / "t")
    landing.truncate_reload(spark.range(5), table)
    with pytest.raises(landing.EmptyLoadError):
        landing.truncate_reload(spark.range(0), table)
    with pytest.raises(PySparkException):
        landing.full_refresh(spark.range(3).select(F.raise_error(F.lit("broken")).cast("long").alias("id")), table)
    assert stored(spark, table) == [0, 1, 2, 3, 4]
    # A table may be replaced by rows read from itself.
    landing.full_refresh(spark.read.parquet(current_folder(spark, table)).where("id > 2"), table)
    assert stored(spark, table) == [3, 4]


class Ended(BaseException):
    """Stands for the end of a driver."""


@pytest.mark.parametrize("step", range(6))
def test_a_reader_finds_a_whole_table_wherever_a_reload_ends(spark, tmp_path, monkeypatch, step):
    """The reload ends at its n-th call to the file system or to the writer; the next one succeeds."""
    table = str(tmp_path / "t")
    for n in (2, 3):
        replace_table(spark.range(n), table)
    calls = iter(range(100))

    def counted(name, real):
        def call(self, *args, **more):
            if next(calls) == step:
                if name == "write":  # a pointer that is cut short
                    real(self, args[0], args[1][:5])
                raise Ended
            return real(self, *args, **more)
        return call

    for name in ("write", "delete", "names"):
        monkeypatch.setattr(Files, name, counted(name, getattr(Files, name)))
    ended = False
    try:
        replace_table(spark.range(7), table)
    except Ended:
        ended = True
    monkeypatch.undo()
    assert stored(spark, table) in (list(range(3)), list(range(7)))
    replace_table(spark.range(4), table)
    assert stored(spark, table) == [0, 1, 2, 3]
    assert len([p for p in os.listdir(table) if p.startswith("v-")]) <= 3
    assert ended or step > 3


def test_ids_longer_than_their_width_stay_whole(spark):
    ids = spark.range(100_000_000, 100_000_020).union(spark.range(7, 8)).select(padded_id("T-", F.col("id"), 8).alias("i"))
    found = {r.i for r in ids.collect()}
    assert len(found) == 21 and {"T-100000019", "T-00000007"} <= found


WANT = "date,ticker,close\n"
CLOSES = StructType([f for f in PRICES if f.name in ("Date", "ticker", "Close", "_source_file", "_ingested_at")])


def test_new_and_missing_columns_are_admitted_by_name(spark, tmp_path):
    zone, table, progress = tmp_path / "zone", str(tmp_path / "t"), str(tmp_path / "p")

    def load(**options):
        return ingest_evolving(spark, str(zone), CLOSES, table, progress, **options)

    land(zone, 1, "A", "2026-08-01,A,1.5", header=WANT)
    assert load() == Loaded(1, 0)
    land(zone, 2, "B", "2.5,x,2026-08-02,B", header="close,Note,date,ticker\n")
    land(zone, 3, "C", "2026-08-03,C", header="date,ticker\n")
    assert load() == Loaded(2, 0)
    land(zone, 4, "D", "y,D,2026-08-04", header="NOTE,ticker,date\n")
    assert load() == Loaded(1, 0)
    loaded = read_ingested(spark, table)
    assert loaded.columns == ["Date", "Close", "ticker", "_source_file", "_ingested_at", "Note"]
    assert [(r["ticker"], r["Close"], r["Note"]) for r in rows(loaded, "Date")] == [
        ("A", 1.5, None), ("B", 2.5, "x"), ("C", None, None), ("D", None, "y")
    ]
    with pytest.raises(FeedError):
        ingest_evolving(spark, str(zone), CLOSES, table, str(tmp_path / "other"))


def test_what_does_not_fit_is_a_reject_and_blocks_nothing(spark, tmp_path):
    zone, table, progress = tmp_path / "zone", str(tmp_path / "t"), str(tmp_path / "p")
    lines = ["2026-08-01,A,1.5", "2026-08-01,A,1.5,EXTRA", "2026-08-02", "2026-08-02,A,oops", "not a day,A,1", '2026-08-03,"A,B",']
    land(zone, 1, "A", *lines, header=WANT)
    land(zone, 2, "B", "2026-08-02,B,2,z", header="date,ticker,close,extra\n")
    land(zone, 3, "C", "2026-08-02,B,2", header="date,ticker,Ticker\n")
    (zone / "year=2026" / "month=08" / "day=03" / "empty.csv").write_text("")
    assert ingest_incremental(spark, str(zone), CLOSES, table, progress) == Loaded(2, 6)
    assert [(r["ticker"], r["Close"]) for r in rows(read_ingested(spark, table), "Date")] == [("A", 1.5), ("A,B", None)]
    found = {(r.file.rsplit("/", 1)[1], r.text) for r in read_rejects(spark, table).collect()}
    assert found == {("A.csv", x) for x in lines[1:5]} | {("B.csv", "date,ticker,close,extra"), ("C.csv", "date,ticker,Ticker")}
    land(zone, 5, "E", "2026-08-09,E,9", header=WANT)
    assert ingest_incremental(spark, str(zone), CLOSES, table, progress) == Loaded(1, 0)
    assert read_ingested(spark, table).count() == 3


def test_a_repeated_batch_replaces_what_it_left(spark, tmp_path, monkeypatch):
    """A run ends after a batch's rows are written and before its commit; readers never see them twice."""
    zone, table, progress = tmp_path / "zone", str(tmp_path / "t"), str(tmp_path / "p")
    land(zone, 1, "A", "2026-08-01,A,1", header=WANT)
    ingest_incremental(spark, str(zone), CLOSES, table, progress)
    land(zone, 2, "B", "2026-08-02,B,2", "2026-08-03,B,2", header=WANT)

    def ends(self, path, text, replace=False):
        assert f"/{COMMITS}/" in path
        raise RuntimeError("ended")

    with monkeypatch.context() as patch:
        patch.setattr(Files, "write", ends)
        with pytest.raises(Exception, match="ended"):
            ingest_incremental(spark, str(zone), CLOSES, table, progress)
    assert read_ingested(spark, table).count() == 1
    assert ingest_incremental(spark, str(zone), CLOSES, table, progress) == Loaded(2, 0)
    assert read_ingested(spark, table).count() == 3


def test_required_files_are_read_by_header_and_ragged_ones_refused(spark, tmp_path):
    fx = BRONZE["fx_rates"]
    path = tmp_path / "fx.csv"
    path.write_text("as_of_date,generated_at,rate_vs_usd,currency\n2026-08-01,now,1.1,EUR\n")
    r = landing.read_required(spark, str(path), fx).first()
    assert (r.currency, r.rate_vs_usd, r.as_of_date) == ("EUR", 1.1, date(2026, 8, 1))
    for line in ("EUR,1.1,2026-08-01,now,EXTRA", "EUR", "EUR,much,2026-08-01,now"):
        path.write_text(f"currency,rate_vs_usd,as_of_date,generated_at\n{line}\n")
        with pytest.raises(Exception, match="MALFORMED"):
            landing.read_required(spark, str(path), fx).collect()
    path.write_text("currency,rate\nEUR,1.1\n")
    with pytest.raises(landing.HeaderError, match="rate_vs_usd"):
        landing.read_required(spark, str(path), fx)


def _tasks(spark, action):
    """What ``action`` returns, and the largest number of tasks of a stage it ran."""
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    result = action()
    jobs = [tracker.getJobInfo(j) for j in set(tracker.getJobIdsForGroup(None)) - before]
    return result, max(tracker.getStageInfo(s).numTasks for job in jobs for s in job.stageIds if tracker.getStageInfo(s))


def test_headers_take_the_start_of_a_file_alone(spark, tmp_path):
    (tmp_path / "big.csv").write_text("\n  \na,b\n" + "1,2\n" * 20_000)
    (tmp_path / "other.csv").write_text("b,a\n1,2\n")
    (tmp_path / "same.csv").write_text("\ufeffa,b\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "blank.csv").write_text("\n \n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        found, most = _tasks(spark, lambda: landing.file_headers(spark, [str(tmp_path / "big.csv")]))
        assert list(found) == ["a,b"] and most == 1
        every = landing.file_headers(spark, [str(tmp_path)])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {h: [os.path.basename(f) for f in files] for h, files in every.items()} == {"a,b": ["big.csv", "same.csv"], "b,a": ["other.csv"]}


def test_rows_and_rejects_are_written_without_a_sort(spark, tmp_path, monkeypatch):
    land(tmp_path / "in", 1, "A", *["2026-08-01,1,1,1,1,1,A,x", "2026-08-01,1,1,1,1,1,A,x,EXTRA"] * 5)
    table, write, most = str(tmp_path / "t"), DataFrameWriter.parquet, []

    def noted(self, path, **options):
        most.append(self._spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", "0"))
        write(self, path, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    assert ingest_incremental(spark, str(tmp_path / "in"), PRICES, table, str(tmp_path / "progress")) == Loaded(5, 5)
    assert most == ["2"] and spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", "0") == "0"
    assert read_rejects(spark, table).count() == 5 and read_ingested(spark, table).count() == 5
