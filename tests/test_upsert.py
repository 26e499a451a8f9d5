from datetime import date

import pytest
from table_rows import rows
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from deskrisk.operators import merge_frames, merge_into, schema_guard
from deskrisk.operators import upsert
from deskrisk.operators.checks import QualityError
from deskrisk.operators.files import Files
from deskrisk.operators.upsert import DuplicateKeyError, SchemaDriftError, read_table, recover
from deskrisk.sources.lake import Lake
from deskrisk.sources.schemas import DATED, GOLD, KEYS, TABLES, UPDATES, business_columns

D1, D2, D3 = date(2026, 1, 1), date(2026, 1, 2), date(2026, 1, 3)
SCHEMA = "d date, k string, v double, w double"


def table(spark, *lines):
    return spark.createDataFrame(list(lines), SCHEMA)


def values(df):
    return [tuple(r[c] for c in ("d", "k", "v", "w")) for r in rows(df, "d", "k")]


def test_listed_columns_change_and_new_rows_are_whole(spark):
    target = table(spark, (D1, "a", 1.0, 10.0), (D1, "b", 2.0, 20.0), (None, "x", 0.0, 0.0))
    source = table(spark, (D1, "b", None, 99.0), (D2, "c", 3.0, 30.0), (None, "x", 7.0, 7.0))
    merged = merge_frames(target, source, ["d", "k"], ["v"])
    assert merged.columns == target.columns
    assert values(merged) == [
        (None, "x", 0.0, 0.0), (None, "x", 7.0, 7.0),  # a NULL key matches nothing
        (D1, "a", 1.0, 10.0), (D1, "b", None, 20.0), (D2, "c", 3.0, 30.0),
    ]


def test_every_column_changes_by_default_and_twice_is_once(spark):
    target = table(spark, (D1, "a", 1.0, 10.0))
    source = table(spark, (D1, "a", 5.0, 50.0))
    once = merge_frames(target, source, ["d", "k"])
    assert values(once) == [(D1, "a", 5.0, 50.0)] == values(merge_frames(once, source, ["d", "k"]))


def test_unknown_columns_are_refused(spark):
    with pytest.raises(SchemaDriftError, match="extra"):
        merge_frames(table(spark), table(spark), ["d"], ["extra"])


def test_stored_table_keeps_other_days_untouched(spark, tmp_path):
    path = str(tmp_path / "t")
    merge_into(spark, path, table(spark, (D1, "a", 1.0, 1.0), (D2, "a", 2.0, 2.0), (D2, "b", 3.0, 3.0)), ["d", "k"], ["v"], "d")
    untouched = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "t" / "d=2026-01-01").glob("*.parquet")}
    change = table(spark, (D2, "b", 9.0, 9.0), (D3, "c", 4.0, 4.0))
    want = [(D1, "a", 1.0, 1.0), (D2, "a", 2.0, 2.0), (D2, "b", 9.0, 3.0), (D3, "c", 4.0, 4.0)]
    for _ in range(2):
        merge_into(spark, path, change, ["d", "k"], ["v"], "d")
        assert values(spark.read.parquet(path)) == want
    assert {p.name: p.stat().st_mtime_ns for p in (tmp_path / "t" / "d=2026-01-01").glob("*.parquet")} == untouched
    assert not list((tmp_path / "t__stage").glob("*"))


class Ended(BaseException):
    """Stands for the end of a driver."""


def test_a_merge_that_ended_is_completed_by_the_next(spark, tmp_path, monkeypatch):
    """It ends between its commit record and the table; then another day is merged."""
    path, keys = str(tmp_path / "t"), (["d", "k"], ["v"], "d")
    merge_into(spark, path, table(spark, (D1, "a", 1.0, 1.0), (D2, "b", 2.0, 2.0)), *keys)

    def ends(*args):
        raise Ended

    with monkeypatch.context() as patch:
        patch.setattr(upsert, "_publish", ends)
        with pytest.raises(Ended):
            merge_into(spark, path, table(spark, (D2, "b", 5.0, 9.0), (D2, "c", 6.0, 6.0)), *keys)
    assert values(spark.read.parquet(path)) == [(D1, "a", 1.0, 1.0), (D2, "b", 2.0, 2.0)]
    merge_into(spark, path, table(spark, (D3, "d", 7.0, 7.0)), *keys)
    assert values(spark.read.parquet(path)) == [
        (D1, "a", 1.0, 1.0), (D2, "b", 5.0, 2.0), (D2, "c", 6.0, 6.0), (D3, "d", 7.0, 7.0)
    ]
    assert not list((tmp_path / "t__stage").glob("*")) and recover(spark, path) == 0


def test_a_merge_that_ended_before_its_commit_is_discarded(spark, tmp_path, monkeypatch):
    path, keys = str(tmp_path / "t"), (["d", "k"], ["v"], "d")
    merge_into(spark, path, table(spark, (D1, "a", 1.0, 1.0)), *keys)

    def cut(self, record, text, replace=False):
        written(self, record, text[:9])
        raise Ended

    written = Files.write
    with monkeypatch.context() as patch:
        patch.setattr(Files, "write", cut)
        with pytest.raises(Ended):
            merge_into(spark, path, table(spark, (D1, "a", 5.0, 9.0)), *keys)
    assert recover(spark, path) == 0 and values(spark.read.parquet(path)) == [(D1, "a", 1.0, 1.0)]
    assert not list((tmp_path / "t__stage").glob("*"))


def test_older_rows_and_rows_that_break_a_rule_change_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    merge_into(spark, path, table(spark, (D1, "a", 5.0, 2.0), (D1, "b", 5.0, None)), ["d", "k"], None, "d")
    change = table(spark, (D1, "a", 6.0, 1.0), (D1, "b", 6.0, None), (D1, "c", 6.0, 3.0))
    merge_into(spark, path, change, ["d", "k"], None, "d", newest_by=["w"])
    want = [(D1, "a", 5.0, 2.0), (D1, "b", 6.0, None), (D1, "c", 6.0, 3.0)]
    assert values(spark.read.parquet(path)) == want
    with pytest.raises(QualityError, match="negative: 1"):
        merge_into(spark, path, table(spark, (D1, "a", -1.0, 9.0)), ["d", "k"], None, "d", rules={"negative": F.count_if(F.col("v") < 0)})
    with pytest.raises(ValueError, match="no d"):
        merge_into(spark, path, table(spark, (None, "a", 1.0, 9.0)), ["d", "k"], None, "d")
    merge_into(spark, path, table(spark).limit(0), ["d", "k"], None, "d")
    assert values(spark.read.parquet(path)) == want and not list((tmp_path / "t__stage").glob("*"))


def test_repeated_key_in_the_source_is_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(DuplicateKeyError):
        merge_into(spark, path, table(spark, (D1, "a", 1.0, 1.0), (D1, "a", 2.0, 1.0)), ["d", "k"], None, "d")
    assert read_table(spark, path) is None
    with pytest.raises(ValueError, match="merge keys"):
        merge_into(spark, path, table(spark), ["k"], None, "d")


def test_schema_guard_names_every_difference(spark):
    want = StructType([StructField("a", DoubleType()), StructField("b", DoubleType())])
    df = spark.range(1).select(F.lit(1).alias("b"), F.lit("x").alias("c"))
    with pytest.raises(SchemaDriftError) as problem:
        schema_guard(df, want)
    assert str(problem.value) == "missing a; unexpected c; b is int, expected double"
    assert schema_guard(spark.range(1).select(F.lit(1.0).alias("b"), F.lit(2.0).alias("a")), want).columns == ["a", "b"]


def test_table_declarations_are_complete():
    assert len(GOLD) == 12 and set(KEYS) == set(DATED) == set(UPDATES) == set(GOLD)
    for name, keys in KEYS.items():
        columns = GOLD[name].names
        assert set(keys) <= set(columns) and DATED[name] in keys
        assert not set(UPDATES[name]) & set(keys) and "_gold_loaded_at" in UPDATES[name]
    assert set(GOLD["limit_breach_log"].names) - set(UPDATES["limit_breach_log"]) == {
        "desk", "breach_start_date", "breach_start_utilisation_pct", "limit_usd", "gross_exposure_at_start_usd"
    }
    for name, schema in TABLES.items():
        assert all(f.metadata["comment"] for f in schema), name
        assert business_columns(name)


def test_lake_refuses_drift(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    assert lake.read("risk_summary").isEmpty() and lake.find("risk_summary") is None
    with pytest.raises(SchemaDriftError, match="missing"):
        lake.merge("risk_summary", spark.range(1).select(F.lit("D").alias("desk")))


def test_a_new_table_is_written_from_the_source_as_staged(spark, tmp_path, monkeypatch):
    path, staged = str(tmp_path / "t"), tmp_path / "t__stage"
    keys = (["d", "k"], None, "d")
    with pytest.raises(QualityError, match="negative: 1"):
        merge_into(spark, path, table(spark, (D1, "a", -1.0, 9.0)), *keys, rules={"negative": F.count_if(F.col("v") < 0)})
    assert read_table(spark, path) is None and not list(staged.glob("*"))
    with monkeypatch.context() as patch:
        patch.setattr(upsert, "_publish", lambda *_: None)  # a run that ends after its commit
        merge_into(spark, path, table(spark, (D1, "a", 1.0, 2.0)), *keys)
    assert [p.name for p in staged.glob("*/*") if p.is_dir()] == ["source"]  # one copy
    assert recover(spark, path) == 1 and values(spark.read.parquet(path)) == [(D1, "a", 1.0, 2.0)]


def test_a_merge_keeps_its_rows_staged_once_while_it_publishes(spark, tmp_path, monkeypatch):
    # The source stayed beside the merged rows, which hold it.
    path, staged, publish = str(tmp_path / "t"), [], upsert._publish
    monkeypatch.setattr(upsert, "_publish", lambda s, p, stage, record: (staged.append(Files(s).names(stage)), publish(s, p, stage, record)))
    for value in (1.0, 2.0):
        merge_into(spark, path, table(spark, (D1, "a", value, value)), ["d", "k"], None, "d")
    assert staged == [["_COMMITTED", "source"], ["_COMMITTED", "merged"]]
    assert values(spark.read.parquet(path)) == [(D1, "a", 2.0, 2.0)]
