"""Personal data and the terms that give it away, with DataFrame functions only.

Protected entities are the values found by four patterns: mail addresses, IP addresses, card and
phone numbers. What else reveals an entity is estimated from the corpus. For an entity e, the
words up to ``CONTEXT`` code points before and after each place of e (not beyond the next match
of its kind) form its windows. With N words in the corpus, c(t) places of a term t, w(e) words in
windows of e and n(t, e) places of t among them,

    information of e     IC(e)     = log2(N / w(e))
    what t tells of e    PMI(t, e) = log2(n(t, e) * N / (c(t) * w(e)))

and t discloses e if PMI(t, e) reaches ``THRESHOLD`` times IC(e) and t was seen in ``CONTEXTS``
or more different windows of e, as one window copied many times is no more evidence than one.
A disclosing term is generalised to its first ``PREFIX`` code points where all words of that
beginning taken together stay below the threshold, and else removed. Counts are of all documents.

Spans are code points, end exclusive, leftmost and without overlap in each kind. A disclosing term
is marked wherever it stands, in all documents, as it gives its entity away without the entity
beside it; only places that overlap a span of a base kind are left to that. A term that discloses
several entities is generalised if that is enough for all of them, and else removed.

Defined results: a null text is the empty text; repeated rows give repeated results; null ids are
kept; empty tables give none; the control characters used as marks count as one ordinary
character each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskrisk.llm.workspace import Workspace

CONTEXT = 80
CONTEXTS = 3
THRESHOLD = 0.9
SHORTEST_TERM = 3
PREFIX = 3
# Words placed at a time: bounds the arrays that grow word by word, however long a text is.
BLOCK = 64

_OPEN, _CLOSE = "\u0001", "\u0002"
_SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
MATCHES = "array<struct<start:bigint,end:bigint,value:string>>"
SPANS = "array<struct<kind:int,start:bigint,end:bigint>>"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(match: Column) -> Column:
    backwards = F.split(F.reverse(_digits(match)), "")

    def weight(digit: Column, place: Column) -> Column:
        value = digit.cast("int")
        doubled = value * 2
        return F.when(place % 2 == 0, value).otherwise(F.when(doubled > 9, doubled - 9).otherwise(doubled))

    total = F.aggregate(F.transform(backwards, weight), F.lit(0), lambda a, b: a + b)
    return F.length(_digits(match)).between(13, 19) & (total % 10 == 0)


def _parts_fit(match: Column) -> Column:
    """Every part at most 255, however many zeros lead it."""
    return match.rlike(r"^(0*([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(\.|$)){4}")


@dataclass(frozen=True)
class Kind:
    """``needed``: what a text must contain for the pattern to match, cheaper than the pattern."""

    name: str
    pattern: str
    needed: str
    valid: Callable[[Column], Column]
    value: Callable[[Column], Column]


# The base kinds in their fixed order. A match may start where a run of its first class
# starts, or where the match before it ended; other starts inside the run cannot match when those
# do not, and trying them makes long runs quadratic. Possessive repeats are never given back here.
KINDS = (
    Kind(
        "email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "[A-Za-z0-9._%+-]@[A-Za-z0-9-]",
        lambda m: F.lit(True), F.lower,
    ),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", r"[0-9]\.[0-9]++\.[0-9]", _parts_fit, lambda m: m),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", r"[0-9](?:[\x20-]?[0-9]){12}", _luhn, _digits),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", lambda m: F.length(_digits(m)).between(9, 15), _digits),
)
TERM = len(KINDS)
REMOVED = "[TERM]"
NAMES = (*(k.name for k in KINDS), "term")


def _lowered(text: Column) -> Column:
    return F.translate(text, ascii_uppercase, ascii_lowercase)


def _words(text: Column) -> Column:
    return F.array_remove(F.split(_lowered(F.coalesce(text, F.lit(""))), _SEPARATOR + "+"), "")


def _placed(pieces: Column, start: Column) -> Column:
    """The words among a few ``pieces``, one separator apart, and where they are, given where the first starts."""
    none = F.array().cast("array<struct<term:string,start:bigint,end:bigint>>")

    def step(state: Column, word: Column) -> Column:
        here = F.struct(word.alias("term"), state["at"].alias("start"), (state["at"] + F.length(word)).alias("end"))
        found = F.when(F.length(word) >= SHORTEST_TERM, F.array_append(state["found"], here)).otherwise(state["found"])
        return F.struct((state["at"] + F.length(word) + 1).alias("at"), found.alias("found"))

    first = F.struct(start.cast("long").alias("at"), none.alias("found"))
    return F.aggregate(pieces, first, step, lambda s: s["found"])


def _pieces(text: Column) -> Column:
    return F.split(_lowered(text), _SEPARATOR)


def _after(gap: Column, end: Column) -> Column:
    """Words that lie whole in the first ``CONTEXT`` code points of the text after a match."""
    near = F.left(gap, F.lit(CONTEXT + 1))
    whole = F.when(F.length(near) > CONTEXT, F.regexp_replace(near, f"{_WORD}$", "")).otherwise(near)
    return _placed(_pieces(whole), end)


def _before(gap: Column, start: Column) -> Column:
    near = F.right(gap, F.lit(CONTEXT + 1))
    whole = F.when(F.length(near) > CONTEXT, F.regexp_replace(near, f"^{_WORD}", "")).otherwise(near)
    return _placed(_pieces(whole), start - F.length(whole))


def _matches(text: Column, kind: Kind, k: int) -> Column:
    """Valid matches of one kind with their windows: ``kind, start, end, entity, words``."""
    pieces = F.split(F.regexp_replace(text, kind.pattern, f"{_OPEN}$0{_CLOSE}"), _OPEN)
    parts = F.transform(
        pieces,
        lambda p: F.struct(
            F.when(p.contains(_CLOSE), F.substring_index(p, _CLOSE, 1)).alias("match"), F.substring_index(p, _CLOSE, -1).alias("gap")
        ),
    )

    def step(state: Column, part: Column) -> Column:
        end = state["at"] + F.coalesce(F.length(part["match"]), F.lit(0))
        place = F.struct(
            part["match"].alias("match"), state["at"].alias("start"), end.alias("end"),
            state["gap"].alias("before"), part["gap"].alias("after"), state["value"].alias("last"),
        )
        return F.struct(
            (end + F.length(part["gap"])).alias("at"), part["gap"].alias("gap"),
            F.coalesce(kind.value(part["match"]), F.lit("")).alias("value"), F.array_append(state["found"], place).alias("found"),
        )

    place = "match:string,start:bigint,end:bigint,before:string,after:string,last:string"
    first = F.struct(
        F.lit(0).cast("long").alias("at"), F.lit("").alias("gap"), F.lit("").alias("value"),
        F.array().cast(f"array<struct<{place}>>").alias("found"),
    )
    places = F.filter(
        F.aggregate(parts, first, step, lambda s: s["found"]), lambda m: m["match"].isNotNull() & kind.valid(m["match"])
    )

    def windowed(m: Column) -> Column:
        value = kind.value(m["match"])
        # Between two places of one entity, the words that the first one's window has are not taken again.
        gap = F.when(m["last"] == value, F.substr(m["before"], F.lit(CONTEXT + 1))).otherwise(m["before"])
        return F.struct(
            F.lit(k).alias("kind"), m["start"].alias("start"), m["end"].alias("end"),
            F.concat(F.lit(f"{kind.name}:"), value).alias("entity"),
            F.concat(_before(gap, m["start"]), _after(m["after"], m["end"])).alias("words"),
        )

    return F.transform(places, windowed)


_MATCH = "struct<kind:int,start:bigint,end:bigint,entity:string,words:array<struct<term:string,start:bigint,end:bigint>>>"


def protected(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row``, ``id``, ``matches`` and ``text``: the base spans of every row, with the windows around them.

    To be stored at once: ``row`` numbers the rows of this one evaluation.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    clean = F.when(text.rlike("[\u0001\u0002]"), F.translate(text, _OPEN + _CLOSE, "~~")).otherwise(text)
    none = F.array().cast(f"array<{_MATCH}>")
    found = [
        F.when(F.col("text").rlike(kind.needed), _matches(F.col("text"), kind, k).cast(f"array<{_MATCH}>")).otherwise(none)
        for k, kind in enumerate(KINDS)
    ]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("text", clean)
    return rows.select(F.monotonically_increasing_id().alias("row"), "id", F.concat(*found).alias("matches"), "text")


def _pairs(found: DataFrame) -> DataFrame:
    """One row for each word of a window: ``row, entity, window, term, start, end``."""
    windows = found.select("row", F.explode("matches").alias("m")).select(
        "row", "m.entity", "m.words", F.xxhash64(F.array_join(F.transform("m.words", lambda w: w["term"]), " ")).alias("window")
    )
    return windows.select("row", "entity", "window", F.explode("words").alias("w")).select("row", "entity", "window", "w.*")


def _blocks(pieces: Column) -> Column:
    """``pieces`` in blocks of ``BLOCK``, each with the place its first piece starts at."""
    none = F.array().cast("array<struct<start:bigint,pieces:array<string>>>")

    def step(state: Column, k: Column) -> Column:
        block = F.slice(state["all"], k * BLOCK + 1, F.lit(BLOCK))
        here = F.struct(state["at"].alias("start"), block.alias("pieces"))
        after = state["at"] + F.length(F.array_join(block, " ")) + 1
        return F.struct(after.alias("at"), state["all"].alias("all"), F.array_append(state["found"], here).alias("found"))

    first = F.struct(F.lit(0).cast("long").alias("at"), pieces.alias("all"), none.alias("found"))
    return F.aggregate(F.sequence(F.lit(0), F.floor((F.size(pieces) - 1) / BLOCK).cast("int")), first, step, lambda s: s["found"])


def _places(pieces: Column, told: Column) -> Column:
    """Spans of the terms of ``told`` among all pieces of a text; a block without one is not gone through."""
    none = F.array().cast("array<struct<term:string,start:bigint,end:bigint>>")

    def in_block(b: Column) -> Column:
        places = F.filter(_placed(b["pieces"], b["start"]), lambda w: F.array_contains(told["term"], w["term"]))
        return F.when(F.arrays_overlap(b["pieces"], told["term"]), places).otherwise(none)

    def span(w: Column) -> Column:
        remedy = F.get(F.filter(told, lambda t: t["term"] == w["term"]), F.lit(0))["remedy"]
        return F.struct(F.lit(TERM).alias("kind"), w["start"].alias("start"), w["end"].alias("end"), remedy.alias("remedy"))

    return F.transform(F.flatten(F.transform(_blocks(pieces), in_block)), span)


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``term`` and ``n`` over all documents; combined map-side, so a frequent word is one row a task."""
    return docs.select(F.explode(_words(F.col(text_col))).alias("term")).groupBy("term").agg(F.count("*").alias("n"))


def disclosing(
    work: Workspace, docs: DataFrame, found: DataFrame, text_col: str = "text", threshold: float = THRESHOLD, contexts: int = CONTEXTS
) -> DataFrame:
    """``entity``, ``term`` and ``remedy`` (what the term is replaced by) for every disclosing term."""
    seen = work.store(
        _pairs(found).groupBy("entity", "term", "window").agg(F.count("*").alias("n"))
        .groupBy("entity", "term").agg(F.sum("n").alias("n"), F.count("*").alias("windows")),
        "seen",
    ).withColumn("prefix", F.left("term", F.lit(PREFIX)))
    candidates = seen.where(F.col("windows") >= contexts)
    prefixes = candidates.select("prefix").distinct()
    counts = work.store(word_counts(docs, text_col).withColumn("prefix", F.left("term", F.lit(PREFIX))), "counts")
    total = F.lit(counts.agg(F.sum("n")).first()[0] or 0).cast("double")
    counts = counts.join(prefixes, "prefix", "left_semi")
    of_prefix = counts.groupBy("prefix").agg(F.sum("n").alias("n_prefix"))
    window_words = seen.groupBy("entity").agg(F.sum("n").alias("w"))
    near_prefix = seen.groupBy("entity", "prefix").agg(F.sum("n").alias("near_prefix"))
    judged = (
        candidates.join(window_words, "entity").join(near_prefix, ["entity", "prefix"])
        .join(counts.select("term", F.col("n").alias("n_term")), "term").join(of_prefix, "prefix")
    )
    needed = F.lit(threshold) * F.log2(total / F.col("w"))

    def told(near: str, of: str) -> Column:
        return F.log2(F.col(near) * total / (F.col(of).cast("double") * F.col("w")))

    general = (F.length("term") > PREFIX) & (told("near_prefix", "n_prefix") < needed)
    return judged.where(told("n", "n_term") >= needed).select(
        "entity", "term", F.when(general, F.concat("prefix", F.lit("*"))).otherwise(REMOVED).alias("remedy")
    )


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, contexts: int = CONTEXTS) -> DataFrame:
    """``row``, ``id`` and ``spans`` (kind, start, end, what to put there) of every row of ``docs``."""
    work = Workspace(docs.sparkSession, "disclosure")
    found = work.store(protected(docs, id_col, text_col), "found")
    return _with_terms(work, docs, found, text_col, threshold, contexts)


def _with_terms(work: Workspace, docs: DataFrame, found: DataFrame, text_col: str, threshold: float, contexts: int) -> DataFrame:
    terms = work.store(disclosing(work, docs, found, text_col, threshold, contexts), "terms")
    work.drop("counts", "seen")
    remedies = terms.groupBy("term").agg(F.max_by("remedy", F.col("remedy") == REMOVED).alias("remedy"))
    words = found.select("row", F.explode(_words(F.col("text"))).alias("term"))
    # Stored, so that its size is known before the texts are joined with it.
    told = work.store(words.join(remedies, "term").groupBy("row").agg(F.collect_set(F.struct("term", "remedy")).alias("told")), "told")
    joined = found.join(told, "row", "left").withColumn("pieces", F.when(F.col("told").isNotNull(), _pieces(F.col("text"))))
    marked = joined.withColumn("terms", F.when(F.col("told").isNotNull(), _places(F.col("pieces"), F.col("told"))))
    base = F.transform(
        "matches",
        lambda m: F.struct(
            m["kind"].alias("kind"), m["start"].alias("start"), m["end"].alias("end"),
            F.concat(F.lit("["), F.upper(F.substring_index(m["entity"], ":", 1)), F.lit("]")).alias("remedy"),
        ),
    )
    alone = F.filter(
        F.coalesce("terms", F.array().cast("array<struct<kind:int,start:bigint,end:bigint,remedy:string>>")),
        lambda t: ~F.exists("matches", lambda m: (m["start"] < t["end"]) & (t["start"] < m["end"])),
    )
    return marked.select("row", "id", F.array_sort(F.concat(base, alone)).alias("spans"))


def written(spans: Column) -> Column:
    """``kind:start:end`` of each span, by kind as listed, then by start, comma-joined."""
    names = F.array(*[F.lit(n) for n in NAMES])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def summarise(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and digest of the base kinds, and all spans, of every row."""
    def count(k: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")

    base = F.filter("spans", lambda s: s["kind"] < TERM)
    return found.select(
        F.col("id").alias(id_col), *[count(k).alias(f"n_{kind.name}") for k, kind in enumerate(KINDS)],
        F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"),
        count(TERM).alias("n_terms"),
    )


def _replaced(text: Column, spans: Column) -> Column:
    """``text`` with its spans replaced; of overlapping spans the whole stretch goes, under the first one's name."""
    empty = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(state: Column, s: Column) -> Column:
        between = F.substr(text, (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int"))
        fresh = F.concat(state["out"], F.array(between, s["remedy"]))
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"), F.when(s["start"] >= state["at"], fresh).otherwise(state["out"]).alias("out")
        )

    rest = F.aggregate(
        F.array_sort(spans, lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(b["end"] - a["end"]).cast("int")),
        empty, step,
        lambda s: F.concat(F.array_join(s["out"], ""), F.substr(text, (s["at"] + 1).cast("int"))),
    )
    return F.when(F.size(spans) > 0, rest).otherwise(text)


def sanitise(docs: DataFrame, text_col: str = "text", threshold: float = THRESHOLD, contexts: int = CONTEXTS) -> DataFrame:
    """``docs`` with personal data replaced by its kind, and disclosing terms generalised or removed.

    All columns stay; a null text stays null. The rows are numbered in one written copy, so that
    spans meet the very row they were found in.
    """
    work = Workspace(docs.sparkSession, "sanitise")
    numbered = work.store(
        docs.select(F.monotonically_increasing_id().alias("row"), F.col(text_col).alias("text"), F.struct("*").alias("whole")), "rows"
    )
    found = work.store(protected(numbered, "row", "text"), "found").select(F.col("id").alias("row"), "id", "matches", "text")
    spans = _with_terms(work, numbered, found, "text", threshold, contexts).select("row", "spans")
    joined = numbered.join(spans, "row")
    rest = [F.col(f"whole.`{c}`") if c != text_col else _replaced(F.col("text"), F.col("spans")).alias(c) for c in docs.columns]
    return joined.select(*rest)
