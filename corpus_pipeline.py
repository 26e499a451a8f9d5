"""The corpus pipeline: quality rules, line dedup, near-dedup, decontamination, tokens.

Every stage takes (spark, docs, sf_dir) and works on all documents its predecessor kept. All but
the last return the columns of ``documents``; ``n_chars`` follows the text. Rows that are equal
in all columns count once where a stage joins by id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deskrisk.llm import bytebpe, contamination, line_dedup, quality, simhash
from deskrisk.llm.settings import vocabulary
from deskrisk.llm.workspace import Workspace


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _where(docs: DataFrame, keep: DataFrame) -> DataFrame:
    """Documents whose id is in ``keep`` (column ``keep_id``)."""
    return docs.join(keep.distinct(), docs["doc_id"].eqNullSafe(keep["keep_id"]), "left_semi")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep. The model learns from the labelled rows of ``docs``."""
    return quality.keep(docs, _table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that an earlier line matches."""
    shorter = line_dedup.remove_lines(docs)
    return shorter.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the document with the smallest id."""
    found = simhash.near_duplicates(docs)
    return _where(docs, found.where("doc_id <=> component_id").select(F.col("doc_id").alias("keep_id")))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    return contamination.remove_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded bytes, one row for each document."""
    return bytebpe.round_trip(docs, *vocabulary())


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", dedup_lines),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("byte-level BPE", tokens),
]
# No SQL: the model of the first stage, fingerprints and tokens are beyond it; tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, over ``documents``."""
    docs = _table(spark, sf_dir, "documents")
    work = Workspace(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        docs = work.store(stage(spark, docs, sf_dir), str(k))
    return docs
