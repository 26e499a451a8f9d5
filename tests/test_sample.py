"""The sample's big table is dealt into parts that Spark sizes."""

from pathlib import Path

import pytest

from deskrisk.operators.scratch import scratch_dir
from deskrisk.sources.sample import Sample
from registry.spark_queries import QUERIES, _sample


@pytest.fixture
def parts(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield 37
    for k, v in kept.items():
        spark.conf.set(k, v)


def test_parts_of_the_big_table_are_not_bound_to_the_cores(spark, tmp_path, parts):
    rows = spark.range(500).selectExpr("id AS l_orderkey", "id % 7 AS l_partkey")
    rows.coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    spread = _sample(spark, str(tmp_path)).lineitem
    assert spread.rdd.getNumPartitions() == parts
    assert spread.count() == 500 and Sample(spark, str(tmp_path)).lineitem.rdd.getNumPartitions() < parts


@pytest.fixture
def tables(spark, tmp_path):
    """Three orders of two lines each, and what they refer to."""
    made = {
        "lineitem": spark.range(6).selectExpr(
            "id % 3 AS l_orderkey", "1L AS l_partkey", "1L AS l_suppkey", "id AS l_linenumber", "id + 10D AS l_extendedprice",
            "DATE '1996-01-01' + CAST(id AS int) AS l_shipdate",
        ),
        "orders": spark.range(3).selectExpr("id AS o_orderkey", "1L AS o_custkey", "'1-URGENT' AS o_orderpriority", "'F' AS o_orderstatus", "DATE '1996-01-01' AS o_orderdate"),
        "customer": spark.sql("SELECT 1L AS c_custkey, 1L AS c_nationkey, 'BUILDING' AS c_mktsegment"),
        "nation": spark.sql("SELECT 1L AS n_nationkey, 1L AS n_regionkey, 'CHINA' AS n_name"),
        "region": spark.sql("SELECT 1L AS r_regionkey, 'ASIA' AS r_name"),
        "part": spark.sql("SELECT 1L AS p_partkey, 'Brand#13' AS p_brand, 1 AS p_size"),
    }
    for name, rows in made.items():
        rows.write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


@pytest.mark.parametrize(("threshold", "shuffles"), [("-1", 1), ("10m", 1)])
def test_trades_are_dealt_by_order_once(spark, tables, threshold, shuffles):
    # Hashed ahead, the big table was shuffled a second time for a join that is no broadcast.
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        plan = _sample(spark, tables).positions._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning(l_orderkey") == shuffles


def test_trades_incremental_leaves_no_landed_files_and_no_settled_trades(spark, tables):
    at = Path(scratch_dir(spark))
    files = lambda: {p for pattern in ("deskrisk-lake-*/landing/*/*", "deskrisk-trades-*") for p in at.glob(pattern)}
    before = files()
    rows = {r.trade_id: r.notional for r in QUERIES["trades_incremental"](spark, tables).collect()}
    assert rows == {"T-00000000": 26.0, "T-00000001": 14.0, "T-00000002": 30.0}
    assert files() == before
