"""Runs registered queries on both engines and compares rows, columns and values.

    python -m registry.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def plain(value):
    """A value both engines' clients spell alike."""
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, (int, float)):
        return float(value)
    if isinstance(value, datetime.date):
        return value.isoformat()
    try:
        return float(value)
    except (TypeError, ValueError):
        return str(value)


def canonical(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def differences(spark, folder: str, run, sql: str) -> str:
    """Empty when equal, else what differs first."""
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        if os.path.exists(f"{folder}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    found = con.execute(sql)
    names = [c[0] for c in found.description]
    want = canonical(names, found.fetchall())
    df = run(spark, folder)
    have = canonical(df.columns, [tuple(r) for r in df.collect()])
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(set(names) ^ set(df.columns))}"
    if len(want) != len(have):
        return f"rows: spark {len(have)}, duckdb {len(want)}"
    bad = [(h, w) for h, w in zip(have, want) if h != w]
    if bad:
        h, w = bad[0]
        cells = [
            f"{c}: {a!r} / {b!r}" for c, a, b in zip(sorted(names), h, w) if a != b
        ]
        return f"{len(bad)} of {len(want)} rows, first: " + "; ".join(cells[:4])
    return "" if want else "both empty"


def main() -> None:
    from pyspark.sql import SparkSession

    from registry.duckdb_queries import all_sql
    from registry.spark_queries import all_queries

    folder, chosen = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    runs, sql = all_queries(), all_sql()
    wrong = 0
    for name in chosen or runs:
        begun = time.time()
        try:
            gap = differences(spark, folder, runs[name], sql[name]) if name in sql else "no SQL"
        except Exception as problem:  # noqa: BLE001  (one broken query must not hide the others)
            gap = f"{type(problem).__name__}: {str(problem)[:600]}"
        wrong += bool(gap)
        print(f"{'DIFF' if gap else 'ok  '} {name:28s} {time.time() - begun:6.2f}s {gap}", flush=True)
    print(f"{wrong} of {len(chosen or runs)} differ; SQL without query: {sorted(set(sql) - set(runs))}")


if __name__ == "__main__":
    main()
