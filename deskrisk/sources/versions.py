"""Tables that are replaced as a whole: a folder for each version, and pointers to them.

``<table>/v-<id>`` holds one version. ``<table>/_pointers/<number>`` names the folder of a version
that was written whole; readers follow the pointer with the highest number. A version is written
first and pointed to last, by a file that did not exist before, so that readers find the old
table whole or the new one, wherever a run ends. Nothing is renamed, which an object store would
do by copying. A pointer ends with a mark; one that was cut short is passed over.

One run at a time writes a table. Of two that do, the one that comes second to its pointer fails
and leaves the table to the first.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession

from deskrisk.operators.files import Files
from deskrisk.operators.scratch import stage_rows

POINTERS = "_pointers"
_END = "\n.\n"
# Versions that stay: the one in force and the one before, which readers may still have open.
KEPT = 2


class EmptyLoadError(RuntimeError):
    """A load that must bring rows brought none."""


def _pointed(files: Files, table: str) -> list[tuple[int, str]]:
    """(number, folder) of every whole pointer, oldest first."""
    found = []
    for name in files.names(f"{table}/{POINTERS}"):
        if name.isdigit():
            text = files.read(f"{table}/{POINTERS}/{name}")
            if text.endswith(_END):
                found.append((int(name), text.removesuffix(_END)))
    return found


def current_folder(spark: SparkSession, table_path: str) -> str | None:
    """The folder of the version in force; None for a path that no version was published at."""
    table = table_path.rstrip("/")
    pointed = _pointed(Files(spark), table)
    return f"{table}/{pointed[-1][1]}" if pointed else None


def replace_table(
    df: DataFrame, table_path: str, least_rows: int = 0, accept: Callable[[dict, DataFrame], None] | None = None, **measures: Column
) -> int:
    """Write a version of the table, point to it, and return its number of rows.

    Before the pointer is written, ``accept`` gets the measures of the written rows and the version
    as it reads; what it raises leaves the old table in force. So do a plan that fails and a load
    with fewer than ``least_rows`` rows. ``df`` may read the table it replaces.
    """
    spark, table = df.sparkSession, table_path.rstrip("/")
    files = Files(spark)
    before = _pointed(files, table)
    known = {folder for _, folder in before}
    for name in files.names(table):  # left behind by runs that ended before their pointer
        if name.startswith("v-") and name not in known:
            files.delete(f"{table}/{name}")
    version = f"v-{uuid.uuid4().hex}"
    try:
        seen = stage_rows(df, f"{table}/{version}", **measures)
        if seen["rows"] < least_rows:
            raise EmptyLoadError(f"{table_path}: the reload brought no rows")
        if accept is not None:
            accept(seen, spark.read.schema(df.schema).parquet(f"{table}/{version}"))
    except BaseException:
        files.delete(f"{table}/{version}")
        raise
    number = max((int(n) for n in files.names(f"{table}/{POINTERS}") if n.isdigit()), default=0) + 1
    files.write(f"{table}/{POINTERS}/{number:012d}", version + _END)
    for old, folder in before[: len(before) + 1 - KEPT]:
        files.delete(f"{table}/{POINTERS}/{old:012d}")
        files.delete(f"{table}/{folder}")
    return seen["rows"]
