"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from deskrisk.llm import (
    bytebpe, compact_windows, contamination, disclosure, hmm, licences, line_dedup, prefix_trie, quality, simhash, spelling, suffixes,
)
from deskrisk.llm.secret_scan import Ledger, summarise
from deskrisk.llm.settings import vocabulary
from deskrisk.llm.sql import SQL
from deskrisk.llm.workspace import Workspace

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.near_duplicate_lines(_table(spark, sf_dir, "documents"))


def op4_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(_table(spark, sf_dir, "documents")).drop("kept")


def op5_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(_table(spark, sf_dir, "documents"))


def op6_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compact_windows.near_duplicate_passages(_table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return contamination.find_leaks(docs, benchmark).drop("items")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytebpe.round_trip(_table(spark, sf_dir, "documents"), *vocabulary())


def op9_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(_table(spark, sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger that is new in this run: every distinct text is scanned once with every rule."""
    docs = _table(spark, sf_dir, "documents")
    ledger = Ledger(spark, Workspace(spark, "secrets").path("ledger"))
    ledger.scan(docs)
    return summarise(ledger.findings(docs))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(_table(spark, sf_dir, "conversations"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


def op13_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return disclosure.summarise(disclosure.find(_table(spark, sf_dir, "documents")))


def all_queries() -> dict[str, Query]:
    return {name: query for name, query in globals().items() if name.startswith("op")}


def all_sql() -> dict[str, str]:
    return dict(SQL)
