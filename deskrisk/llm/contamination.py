"""Benchmark decontamination with DataFrame functions only.

Benchmark texts and documents are normalised alike: A-Z lower-cased, words are runs of digits,
letters and everything beyond ASCII. A window is ten consecutive words of an item; an item with
fewer is one window. The hashes of the first three words of all windows are a broadcast set, and
documents are scanned word by word against it. What it holds is verified: the text of the whole
window is looked up among the windows, in a join that gets the hits alone.

The set is broadcast in slices of ``AT_ONCE`` hashes at most, one scan each. An ordinary benchmark
is one slice; a larger one takes more scans and no more memory.

Defined results: a null text has no words; rows equal in id and text are one document; an empty
table gives no rows; without benchmark rows nothing is contaminated; an item without an id contaminates
like any other, but is not among the items counted; other columns are ignored.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskrisk.llm.workspace import Workspace

WINDOW = 10
HEAD = 3
# Hashes that are broadcast at once: some 40 bytes each as a hash table.
AT_ONCE = 1 << 21

_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), ascii_uppercase, ascii_lowercase)
    return F.array_remove(F.split(lowered, _SEPARATORS), "")


def _head(words: Column, start: Column, size: int) -> Column:
    return F.xxhash64(F.lit(size), *[F.get(words, start + k) for k in range(size)])


def item_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item``, ``length``, ``window`` and ``head``: each distinct window of each item."""
    items = benchmark.select(F.col(id_col).alias("item"), words_of(F.col(text_col)).alias("words")).where("size(words) > 0")
    length = F.least(F.size("words"), F.lit(WINDOW))
    at = items.select("item", length.alias("length"), "words", F.explode(F.sequence(F.lit(0), F.size("words") - length)).alias("at"))
    own = at.select("item", "length", F.slice("words", F.col("at") + 1, F.col("length")).alias("words"))
    head = F.lit(None).cast("long")
    for size in range(1, HEAD + 1):
        head = F.when(F.least("length", F.lit(HEAD)) == size, _head(F.col("words"), F.lit(0), size)).otherwise(head)
    return own.select("item", "length", F.array_join("words", " ").alias("window"), head.alias("head")).distinct()


class Leaks:
    """The benchmark's windows, prepared for scanning documents."""

    def __init__(self, benchmark: DataFrame) -> None:
        self.work = Workspace(benchmark.sparkSession, "leaks")
        self.windows = self.work.store(item_windows(benchmark), "windows")
        self.lengths = sorted(r["length"] for r in self.windows.select("length").distinct().collect())  # WINDOW rows at most
        self.heads = self.work.store(self.windows.select("head").distinct(), "heads")
        self.slices = max(1, -(-self.heads.count() // AT_ONCE))

    @staticmethod
    def _entry(words: Column, size: int):
        return lambda i: F.struct(i.alias("at"), _head(words, i, size).alias("head"))

    def _starts(self, words: Column) -> Column:
        """Every place of a text and the hash of the words there; a first entry without a place stands for the text."""
        place = "array<struct<at:int,head:bigint>>"
        parts = [F.array(F.struct(F.lit(-1).alias("at"), F.lit(None).cast("long").alias("head"))).cast(place)]
        for size in sorted({min(HEAD, n) for n in self.lengths}):
            places = F.when(F.size(words) >= size, F.sequence(F.lit(0), F.size(words) - size)).otherwise(F.array().cast("array<int>"))
            parts.append(F.transform(places, self._entry(words, size)).cast(place))
        return F.concat(*parts)

    def occurrences(self, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
        """``id``, ``key``, ``n_words`` and ``at``, ``length``, ``item`` of each window found; a row with a null ``at`` for each text, too."""
        rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key"), words_of(F.col(text_col)).alias("words"))
        # There is always an entry. Of an inner generator, Spark would filter on the array first, with the words made anew
        # for each place in it.
        places = rows.withColumn("starts", self._starts(F.col("words"))).select("id", "key", "words", F.inline_outer("starts"))
        found = None
        for k in range(self.slices):
            heads = self.heads.where(F.pmod("head", F.lit(self.slices)) == k).select("head", F.lit(True).alias("held"))
            part = places.join(F.broadcast(heads), "head", "left").where(F.col("held") if k else F.col("held") | (F.col("at") < 0))
            found = part if found is None else found.unionByName(part)
        # The window of each length there is, where the text goes on that far.
        lengths = F.array(*[F.lit(n) for n in self.lengths]).cast("array<int>")
        long_enough = F.filter(lengths, lambda n: (F.col("at") >= 0) & (F.col("at") + n <= F.size("words")))
        hits = found.select("id", "key", F.size("words").alias("n_words"), "words", "at", F.explode_outer(long_enough).alias("length"))
        hits = hits.select(
            "id", "key", "n_words", "at", "length",
            F.when(F.col("length").isNotNull(), F.array_join(F.slice("words", F.col("at") + 1, F.col("length")), " ")).alias("window"),
        )
        known = self.windows.select("length", "window", "item", F.lit(True).alias("held"))  # an item may be null
        return hits.join(known, ["length", "window"], "left").select(
            "id", "key", "n_words", F.when(F.col("held"), F.col("at")).alias("at"), "length", "item"
        )


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: words, words hit, items found, and whether it is contaminated."""
    hits = Leaks(benchmark).occurrences(docs, id_col, text_col)
    covered = F.when(F.col("at").isNotNull(), F.sequence("at", F.col("at") + F.col("length") - 1))
    per_doc = hits.groupBy("id", "key", "n_words").agg(
        F.size(F.array_distinct(F.flatten(F.collect_set(covered)))).cast("long").alias("n_hit"),
        F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items"),
    )
    return per_doc.select(
        F.col("id").alias(id_col), F.col("n_words").cast("long").alias("n_words"), "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"), "items",
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that hold a benchmark window; all columns stay.

    Contaminated texts are known by two hashes, which are joined without a hint: Spark broadcasts
    them if their stored size allows it.
    """
    leaks = Leaks(benchmark)
    second = F.xxhash64(F.lit(1), F.col(text_col))
    hits = leaks.occurrences(docs.select(second.alias("second"), text_col), "second", text_col).where("at is not null")
    bad = leaks.work.store(hits.select("key", F.col("id").alias("second")).distinct(), "bad")
    whole = docs.select(F.xxhash64(text_col).alias("key"), second.alias("second"), F.struct("*").alias("row"))
    return whole.join(bad, ["key", "second"], "left_anti").select(*[F.col(f"row.`{c}`") for c in docs.columns])
