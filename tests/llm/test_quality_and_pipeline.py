"""Quality rules on labelled rows, and the pipeline's stages."""

import random
import re
from collections import Counter

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from deskrisk.llm import queries, quality, sql

SF = "/root/testdata/sf0.001"


def test_base_counts_equal_plain_counting(docs, empty, spark, corpus):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.quality_rules(docs, labels).collect()}
    for i, t in corpus:
        if i is None:
            continue
        text = t or ""
        own = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = [tuple(own[k : k + 3]) for k in range(len(own) - 2)]
        times = Counter(windows)
        repeated = {k + j for k, w in enumerate(windows) if times[w] > 1 for j in range(3)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        r = got[i]
        failed = len(own) < 50 or 100 * len(repeated) > 50 * len(own)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(own), sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated)
        )
        assert (r.base_failed, r.kept, r.probability) == (failed, not failed, None)
    assert quality.quality_rules(empty, labels).count() == 0


def test_the_model_tells_held_out_rows_apart(spark):
    rng = random.Random(1)
    rows, marks = [], []
    for i in range(400):
        good = i % 3 > 0
        own = [("".join(rng.choice("aeiourstln") for _ in range(rng.randint(3, 8))) + ("" if good else "###")) for _ in range(80)]
        rows.append((i, " ".join(own)))
        marks.append((i, int(good)) if i < 300 else (i, None))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    out = quality.quality_rules(docs, labels).where("doc_id >= 300").collect()
    right = sum(r.kept == (r.doc_id % 3 > 0) for r in out)
    assert right / len(out) >= 0.95
    assert all(0 <= r.probability <= 1 for r in out)
    kept = {r.doc_id for r in quality.keep(docs, labels).collect()}
    assert kept == {r.doc_id for r in quality.quality_rules(docs, labels).where("kept").collect()}


def test_calibration_follows_the_shares():
    slope, offset = quality.calibrate([-2.0] * 100 + [2.0] * 100, [1] * 20 + [0] * 80 + [1] * 90 + [0] * 10)
    p = 1 / (1 + 2.718281828 ** -(slope * 2 + offset))
    assert p == pytest.approx(0.9, abs=0.02)
    assert quality.calibrate([1.0], [1]) == (1.0, 0.0)


def test_stages_keep_columns_and_act_on_what_is_left(spark, docs):
    """Each stage on the corpus of awkward cases: columns stay, decisions take effect."""
    kept = corpus_pipeline.near_dedup(spark, docs, SF)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert set(range(6, 20)) <= set(ids) and len([i for i in ids if i is not None and 45 <= i < 57]) == 1
    shorter = corpus_pipeline.dedup_lines(spark, docs, SF)
    assert shorter.schema == docs.schema
    assert shorter.where("n_chars <> length(text)").count() == 0
    assert corpus_pipeline.decontaminate(spark, docs, SF).columns == docs.columns
    for name, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, docs.limit(0), SF).count() == 0, name


def test_other_labels_are_ignored_and_the_input_may_come_in_any_order(spark):
    rows = [(i, f"plain words of prose number {i} " * 12 if i % 2 else f"### {i} $$ buy now @@ " * 14) for i in range(60)]
    docs = spark.createDataFrame([*rows, (60, None), (61, "")], "doc_id long, text string")
    labels = [(i, i % 2) for i in range(60)]
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    more = spark.createDataFrame([*labels, (3, 2), (4, -1), (5, None)], "doc_id long, quality int")

    def judged(df, marks):
        return sorted((r.doc_id, r.kept, r.probability) for r in quality.quality_rules(df, marks).collect())

    want = judged(docs, known)
    assert judged(docs.repartition(5), more.repartition(4)) == want
    assert judged(docs.limit(0), known) == []
    assert corpus_pipeline.STAGES[0][1](spark, spark.read.parquet(f"{SF}/documents.parquet").limit(0), SF).count() == 0


def test_run_applies_all_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF)
        assert docs.count() <= before.count(), name
    out = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, docs.collect()))


def test_every_query_is_registered_once_and_sql_belongs_to_one():
    names = list(queries.all_queries())
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14))
    assert set(sql.SQL) <= set(names)


@pytest.mark.parametrize("name", sorted(sql.SQL))
def test_sql_gives_the_same_rows(spark, name):
    duckdb = pytest.importorskip("duckdb")
    session = duckdb.connect()
    for table in ("documents", "benchmark"):
        session.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got = queries.all_queries()[name](spark, SF)
    columns = sorted(got.columns)
    want = session.sql(sql.SQL[name]).select(*columns).fetchall()
    assert sorted(map(tuple, got.select(*[F.col(c) for c in columns]).collect())) == sorted(want)
