"""Quality rules: base counts, and a calibrated logistic regression on hashed n-grams.

Features are word unigrams, word bigrams and character 4-grams, hashed into one table of
``DIMENSIONS`` weights; each family is scaled by the root of its size, so that long texts weigh
more, but not without bound. The model is trained by stochastic gradient steps with the weights
averaged over the partitions after each round. A fold that took no part in training calibrates
margins to probabilities (a logistic curve). Texts are scored in Arrow batches.

Training takes at most ``TRAIN_ROWS`` labelled rows, chosen by a hash of the id; every document
is counted and scored whole.

Defined results: a null text has no words and fails the base rules; repeated rows give repeated
results; an empty table gives none. Without labelled rows of both classes there is no verdict:
``probability`` is null and ``kept`` follows the base rules alone. Labels with a quality other than 0
or 1, or without one, are ignored; a document with several labels counts once for each. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskrisk.llm.workspace import Workspace, map_batches, ship

DIMENSIONS = 1 << 18
# Bound of the labelled sample, and the partitions it is trained in.
TRAIN_ROWS = 8_192
TRAIN_PARTS = 6
ROUNDS = 6
RATE = 0.5
# Fixed thresholds.
LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of the words
KEEP_AT = 0.5

_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xBF58476D1CE4E5B9)
_SHIFT = np.uint64(64 - 18)


def base_counts(data: bytes, words: list[bytes], length: int) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text in UTF-8."""
    blanks = len(data) - len(data.translate(None, b" \t\n\r\x0b\x0c"))
    symbols = len(data) - len(data.translate(None, b"#*$%&|<>"))
    lines = [line for line in data.split(b"\n") if line.strip()]
    return len(words), length - blanks, symbols, len(lines) - len(set(lines)), repeated_words(words)


def repeated_words(words: list[bytes]) -> int:
    """Words in three-word windows that the text has twice or more."""
    n = len(words) - 2
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n + 2)
    if len(number) < 1 << 20:
        windows = (ids[:-2] << 40) | (ids[1:-1] << 20) | ids[2:]
    else:
        pairs = np.unique(ids[:-2] * len(number) + ids[1:-1], return_inverse=True)[1]
        windows = pairs * len(number) + ids[2:]
    order = np.argsort(windows)
    sorted_windows = windows[order]
    same = sorted_windows[1:] == sorted_windows[:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n + 2, bool)
    for shift in range(3):
        covered[shift : n + shift] |= twice
    return int(covered.sum())


def hashed(text: str, words: list[bytes]) -> list[np.ndarray]:
    """Table positions of the three families of n-grams, one entry for each occurrence."""
    single = np.fromiter(map(crc32, words), np.uint64, len(words))
    pairs = single[:-1] * _STEP + single[1:]
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    two = (points[:-1] << np.uint64(21)) | points[1:]
    four = two[:-2] * _STEP + two[2:] + np.uint64(7)
    return [((values * _MIX) >> _SHIFT).astype(np.int64) for values in (single, pairs, four)]


def _margin(weights: np.ndarray, families: list[np.ndarray]) -> float:
    return float(sum(weights[f].sum() / np.sqrt(len(f)) for f in families if len(f)))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["order", "quality", "held", "places", "values"]
    for batch in batches:
        for row in batch.to_pylist():
            text = row["text"] or ""
            families = hashed(text, text.encode().split())
            places = np.concatenate(families)
            values = np.concatenate([np.full(len(f), 1 / np.sqrt(max(1, len(f)))) for f in families])
            unique, inverse = np.unique(places, return_inverse=True)
            summed = np.bincount(inverse, weights=values, minlength=len(unique)).astype(np.float32)
            columns = [[row["order"]], [row["quality"]], [row["held"]], [unique.astype(np.int32).tobytes()], [summed.tobytes()]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)


def train(docs: DataFrame, labels: DataFrame, work: Workspace, id_col: str = "doc_id", text_col: str = "text"):
    """Weights and calibration (slope, offset), or None where a class has no labelled row."""
    spark = docs.sparkSession
    wanted = (
        labels.where("quality in (0, 1)")
        .select(F.col(id_col).alias("id"), F.col("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("id"), "quality").limit(TRAIN_ROWS)
    )
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sample = texts.join(F.broadcast(wanted), "id").select(  # TRAIN_ROWS pairs of numbers at most
        "text", "quality", (F.pmod(F.xxhash64("id", F.lit("fold")), F.lit(5)) == 0).alias("held"), F.xxhash64("id").alias("order")
    )
    features = map_batches(sample, _features, "order bigint, quality bigint, held boolean, places binary, values binary")
    # Dealt and sorted by the rows themselves, so that the steps do not depend on how the input is cut.
    rows = work.store(features.repartition(TRAIN_PARTS, "order").sortWithinPartitions("order", "quality", "places"), "features")
    counts = {r["quality"]: r["count"] for r in rows.where("not held").groupBy("quality").count().collect()}
    if not counts.get(0) or not counts.get(1):
        return None
    total = counts[0] + counts[1]
    balance = {0: total / (2 * counts[0]), 1: total / (2 * counts[1])}
    weights, bias = np.zeros(DIMENSIONS, np.float32), 0.0
    learning = rows.where("not held").coalesce(TRAIN_PARTS)
    for round_ in range(ROUNDS):
        sent = spark.sparkContext.broadcast((weights, bias))
        step = RATE / (1 + round_)

        def epoch(batches: Iterator[pa.RecordBatch], sent=sent, step=step) -> Iterator[pa.RecordBatch]:
            own, offset = sent.value[0].copy(), sent.value[1]
            seen = 0
            for batch in batches:
                for row in batch.to_pylist():
                    at, x = np.frombuffer(row["places"], np.int32), np.frombuffer(row["values"], np.float32)
                    y = row["quality"]
                    error = y - 1 / (1 + np.exp(-float(np.clip(own[at] @ x + offset, -30, 30))))
                    own[at] += np.float32(step * balance[y] * error) * x
                    offset += 0.1 * step * balance[y] * error
                    seen += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([own.tobytes()]), pa.array([float(offset)]), pa.array([seen])], ["own", "offset", "seen"]
            )

        # One fixed-size table of weights from each of TRAIN_PARTS partitions.
        parts = map_batches(learning, epoch, "own binary, offset double, seen bigint").where("seen > 0").collect()
        seen = sum(p["seen"] for p in parts)
        weights = sum(np.frombuffer(p["own"], np.float32) * np.float32(p["seen"] / seen) for p in parts)
        bias = sum(p["offset"] * p["seen"] / seen for p in parts)
    sent = spark.sparkContext.broadcast((weights, bias))

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                float(sent.value[0][np.frombuffer(r["places"], np.int32)] @ np.frombuffer(r["values"], np.float32)) + sent.value[1]
                for r in batch.to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column("quality"), pa.array(found, pa.float64())], ["quality", "margin"])

    held = map_batches(rows.where("held"), margins, "quality bigint, margin double").collect()  # part of the bounded sample
    return weights, bias, calibrate([r["margin"] for r in held], [r["quality"] for r in held])


def calibrate(margins: list[float], quality: list[int]) -> tuple[float, float]:
    """Slope and offset of the logistic curve through held-out margins (smoothed targets)."""
    if not margins or len(set(quality)) < 2:
        return 1.0, 0.0
    x, y = np.array(margins), np.array(quality)
    n1, n0 = y.sum(), (1 - y).sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    slope, offset = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * x + offset, -30, 30)))
        w = np.maximum(p * (1 - p), 1e-9)
        g = np.array([((target - p) * x).sum(), (target - p).sum()])
        h = np.array([[(w * x * x).sum() + 1e-6, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-6]])
        change = np.clip(np.linalg.solve(h, g), -2, 2)
        slope, offset = slope + change[0], offset + change[1]
        if np.abs(change).max() < 1e-6:
            break
    return float(slope), float(offset)


COLUMNS = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, kept boolean, probability double"
)


def judge_text(text: str | None, model) -> tuple:
    """The values of ``COLUMNS`` for one text."""
    text = text or ""
    data = text.encode()
    words = data.split()
    counts = base_counts(data, words, len(text))
    failed = counts[0] < LEAST_WORDS or 100 * counts[4] > MOST_REPEATED * counts[0]
    probability = None
    if model is not None:
        weights, bias, (slope, offset) = model
        margin = _margin(weights, hashed(text, words)) + bias
        probability = float(1 / (1 + np.exp(-np.clip(slope * margin + offset, -700, 700))))
    kept = not failed and (probability is None or probability >= KEEP_AT)
    return *counts, failed, kept, probability


def judge(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, base verdict, probability of good quality and final verdict of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # DIMENSIONS weights, whatever the input
    names = [id_col, *(c.split()[0] for c in COLUMNS.split(", "))]
    kinds = [pa.int64()] * 5 + [pa.bool_(), pa.bool_(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [judge_text(t.as_py(), sent.value) for t in batch.column(1)]
            columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names)

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(id_col, text_col), run, f"`{id_col}` {kind}, {COLUMNS}")


def quality_rules(docs: DataFrame, labels: DataFrame, training_docs: DataFrame | None = None) -> DataFrame:
    """Train on the labelled rows of ``training_docs`` (``docs`` by default) and judge ``docs``."""
    work = Workspace(docs.sparkSession, "quality")
    model = train(docs if training_docs is None else training_docs, labels, work)
    work.drop()
    return judge(docs, model)


def keep(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns as they are, without a shuffle."""
    work = Workspace(docs.sparkSession, "quality")
    model = train(docs, labels, work, id_col, text_col)
    work.drop()
    verdict = _judge_column(docs, model)
    return docs.where(verdict(F.col(text_col)))


def _judge_column(docs: DataFrame, model):
    """The final verdict as a function of a text column."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    ship(docs.sparkSession)

    @F.pandas_udf("boolean")
    def kept(texts: pd.Series) -> pd.Series:
        return pd.Series([judge_text(text, sent.value)[6] for text in texts], dtype=bool)

    return kept
