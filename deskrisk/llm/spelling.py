"""Spelling variants: words one edit apart, found by walking a trie that is a table.

A word in direction > or < (reversed) is written ``>word.``, so that the end is a symbol, too. The
trie is the table of its edges: a node (the symbols read so far), the next two symbols, and so
the node two levels down. A state is a word, how many of its symbols are read, the node they led
to, and the edits made (0 before, 1 after the first step). The first step reads up to a place in
the second half without an edit, as the word's own symbols lead there, and makes one: it replaces
the next symbol (an edge whose second symbol is right and whose first is not) or skips it. Each
further step joins all states with the edges of their node and their next two symbols; states
without such an edge are gone. A state that has read its end is at the end of another word, one
edit away. An edit in the first half of a word is one in the second half of its reverse, so that
the walk begins at deep nodes with few edges. An inserted symbol is one skipped in the other word.

A node has at most as many edges as there are pairs of letters, and a word at most some hundred
neighbours for each of its letters, whatever the number of words.

Words longer than ``DEEPEST`` letters, which would need as many steps, meet by hashes of what is
left of them without one letter instead; the meetings are verified on the words.

Defined results: a null text has no words; a null id is written as nothing; rows count as often as
they are there; empty tables give no words; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskrisk.llm.workspace import Workspace, map_batches

SHORTEST = 6
LEAST_COUNT = 5
TIMES_AS_FREQUENT = 5
DEEPEST = 64
# Fixed value: one run in so many loses a letter, by its checksum.
MISSPELT = 199
_LETTERS = "a-zÀ-ÿ"


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_COUNT) -> DataFrame:
    """``word`` and ``n``: words of ``SHORTEST`` letters or more and how often they occur."""
    lowered = F.translate(F.coalesce(F.col(text_col), F.lit("")), ascii_uppercase, ascii_lowercase)
    long_runs = F.filter(F.split(lowered, f"[^{_LETTERS}]+"), lambda r: F.length(r) >= SHORTEST)
    owner = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"))
    runs = docs.select(owner.alias("owner"), F.explode(long_runs).alias("run"))
    checksum = F.crc32(F.concat("owner", "run").cast("binary"))
    at = (F.col("checksum") % F.length("run")).cast("int")
    shorter = F.concat(F.left("run", at), F.substr("run", at + 2))
    word = F.when(F.col("checksum") % MISSPELT == 0, shorter).otherwise(F.col("run"))
    words = runs.withColumn("checksum", checksum).select(word.alias("word")).where(F.length("word") >= SHORTEST)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def _oriented(words: DataFrame) -> DataFrame:
    """``path`` (the word with its direction and end), ``size`` of it and ``start``, the symbols read without an edit at least."""
    half = F.floor(F.length("word") / 2).cast("int")
    return words.select(
        F.explode(
            F.array(
                F.struct(F.concat(F.lit(">"), "word", F.lit(".")).alias("path"), (half + 1).alias("start")),
                F.struct(F.concat(F.lit("<"), F.reverse("word"), F.lit(".")).alias("path"), (F.length("word") - half + 1).alias("start")),
            )
        ).alias("w")
    ).select("w.path", F.length("w.path").alias("size"), "w.start")


def _next(places: int, after: int = 0) -> Column:
    """The symbols of the path that follow those read."""
    return F.substr("path", F.col("read") + 1 + after, F.lit(places))


def edges(paths: DataFrame) -> DataFrame:
    """The trie: ``node`` and ``label``, its next two symbols (one before the end)."""
    depths = F.sequence(F.lit(1 + SHORTEST // 2), F.col("size") - 1)
    at = paths.select("path", F.explode(depths).alias("read"))
    return at.select(F.left("path", F.col("read")).alias("node"), _next(2).alias("label")).distinct()


def _advance(states: DataFrame, trie: DataFrame) -> DataFrame:
    """States whose next two symbols are on an edge, at its end."""
    wanted = states.withColumn("label", _next(2))
    met = wanted.join(trie, ["node", "label"])
    return met.select("path", (F.col("read") + F.length("label")).alias("read"), F.concat("node", "label").alias("node"))


def _first_edit(paths: DataFrame, trie: DataFrame) -> DataFrame:
    """States after the one edit and the symbols that come with it."""
    before = paths.select("path", F.explode(F.sequence(F.col("start"), F.col("size") - 2)).alias("read")).withColumn(
        "node", F.left("path", F.col("read"))
    )
    skipped = before.select("path", (F.col("read") + 1).alias("read"), "node")
    pairs = trie.where(F.length("label") == 2).select("node", F.right("label", F.lit(1)).alias("second"), "label")
    replaced = (
        before.withColumn("second", _next(1, after=1)).join(pairs, ["node", "second"])
        .where(F.left("label", F.lit(1)) != _next(1))
        .select("path", (F.col("read") + 2).alias("read"), F.concat("node", "label").alias("node"))
    )
    return replaced.unionByName(_advance(skipped, trie))


def _word_of(path: str) -> Column:
    inner = F.substr(path, F.lit(2), F.length(path) - 2)
    return F.when(F.left(F.col(path), F.lit(1)) == "<", F.reverse(inner)).otherwise(inner)


def _walk(work: Workspace, words: DataFrame) -> DataFrame:
    """``word`` and ``near`` of pairs that the trie's walk finds, each from one side at least."""
    paths = work.store(_oriented(words), "paths")
    trie = work.store(edges(paths), "trie")
    states = work.store(_first_edit(paths, trie), "states-0")
    at_end = F.col("read") == F.length("path")
    found, k = [], 0
    while True:
        ends = states.where(at_end).select(_word_of("path").alias("word"), _word_of("node").alias("near"))
        found.append(work.store(ends, f"found-{k}"))
        alive = states.where(~at_end)
        if alive.isEmpty():  # a symbol pair is read a step, so this ends by DEEPEST / 2 steps
            break
        k += 1
        states = work.store(_advance(alive, trie), f"states-{k}")
        work.drop(f"states-{k - 1}")
    work.drop(f"states-{k}", "trie", "paths")
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs


_BASE = np.uint64(0x9E3779B97F4A7C15)


def _one_less(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each word: the hash of what is left without letter ``at``, and of the whole (``at`` null)."""
    for batch in batches:
        for key, word in zip(batch.column("key").to_pylist(), batch.column("word").to_pylist(), strict=True):
            letters = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64)
            letters = (letters + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
            letters ^= letters >> np.uint64(29)
            power = np.full(len(letters), _BASE)
            power[0] = 1
            power = np.multiply.accumulate(power)
            here, one_down = letters * power, letters[1:] * power[:-1]
            head = np.concatenate([np.zeros(1, np.uint64), np.cumsum(here)])  # of the letters before each
            tail = np.concatenate([np.cumsum(one_down[::-1])[::-1], np.zeros(1, np.uint64)])  # of those after, moved up
            hashes = np.concatenate([head[:-1] + tail, head[-1:]]).astype(np.int64)
            yield pa.record_batch(
                {
                    "key": pa.array(np.full(len(hashes), key, np.int64)),
                    "at": pa.array([*range(len(letters)), None], pa.int32()),
                    "left": pa.array(hashes),
                }
            )


def _long_pairs(work: Workspace, words: DataFrame) -> DataFrame:
    """Pairs of words of ``DEEPEST`` letters or more, one of them longer, by what is left without one letter."""
    named = work.store(words.select(F.monotonically_increasing_id().alias("key"), "word"), "long")
    rest = work.store(map_batches(named, _one_less, "key long, at int, left long"), "rest")
    cut, whole = rest.where("at is not null"), rest.where("at is null").select("left", F.col("key").alias("near"))
    # Words with the same rest at one place differ there alone: at most one for each letter there is.
    other = cut.select("at", "left", F.col("key").alias("near"))
    met = cut.join(other, ["at", "left"]).where("key <> near").select("key", "near").unionByName(
        cut.select("key", "left").distinct().join(whole, "left").select("key", "near")
    )
    first, second = named, named.select(F.col("key").alias("near"), F.col("word").alias("near_word"))
    return (
        met.distinct().join(first, "key").join(second, "near")
        .where(F.levenshtein("word", "near_word", 1) == 1)
        .where(F.greatest(F.length("word"), F.length("near_word")) > DEEPEST)
        .select("word", F.col("near_word").alias("near"))
    )


def neighbours(work: Workspace, words: DataFrame) -> DataFrame:
    """``word`` and ``near``: all ordered pairs of words one edit apart."""
    found = _walk(work, words.where(F.length("word") <= DEEPEST))
    far = words.where(F.length("word") >= DEEPEST)
    if not far.where(F.length("word") > DEEPEST).isEmpty():
        found = found.unionByName(_long_pairs(work, far))
    return found.unionByName(found.select(F.col("near").alias("word"), F.col("word").alias("near"))).distinct()


def _roots(work: Workspace, forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` for words that have a form: chains are halved until nothing moves.

    Forms occur at least ``TIMES_AS_FREQUENT`` times as often as their words, so that chains are short.
    """
    reached, k = work.store(forms.select("word", F.col("form").alias("root")), "roots-0"), 0
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = reached.join(onward, "root", "left")
        if moved.where("further is not null").isEmpty():
            return reached
        k += 1
        reached = work.store(moved.select("word", F.coalesce("further", "root").alias("root")), f"roots-{k}")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every word with its count, its near words' count, its form and its root."""
    work = Workspace(docs.sparkSession, "spelling")
    words = work.store(vocabulary(docs, id_col, text_col), "words")
    others = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    judged = work.store(
        neighbours(work, words).join(others, "near").groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
        .join(words, "word")
        .select("word", "n_near", F.when(-F.col("best.less") >= F.col("n") * TIMES_AS_FREQUENT, F.col("best")).alias("best"))
        .select("word", "n_near", F.col("best.near").alias("form"), (-F.col("best.less")).alias("form_n")),
        "judged",
    )
    roots = _roots(work, judged.where("form is not null"))
    return (
        words.join(judged, "word", "left").join(roots, "word", "left")
        .select(
            "word", "form", F.coalesce("root", "word").alias("root"), "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n",
        )
    )
