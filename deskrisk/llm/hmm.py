"""LM scoring with a hidden Markov language model.

Tokens are the words of a text, A-Z lower-cased, and one end. The ``HEAD`` most frequent training
tokens that occur twice or more, of ``LONGEST`` bytes at most, are observations of their own; every
other token, known or not, is seen through one of ``TAIL`` classes by its hash, with a share of the
class. Of a class, a known token has its count, and all unknown ones together have as much as the
tokens seen once, which tell how often a new one comes. So the model's tables are of fixed size, and
every token of every text has a probability that depends on its count in the whole training corpus.

Baum-Welch: each partition runs the scaled forward-backward recursion over all its training texts
and sends expected counts; they are summed by observation and give the next tables. A state's counts
are smoothed by the corpus' own shares, with as much weight as the state has different observations
(Witten and Bell), so that a corpus of few repeated words is smoothed more. The score of a
text is the exact likelihood from the scaled forward recursion. Texts of one batch are stepped
through side by side, longest first.

The counts of tokens outside the head are joined by token, never broadcast.

Defined results: a null text is empty and has one token, the end; a null id is not held out;
repeated rows give repeated results and count as often in training; an empty table gives none; if
no row trains, every token is unknown; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import filterfalse
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskrisk.llm.workspace import Workspace, map_batches

STATES = 8
ROUNDS = 4
HEAD = 1 << 18
TAIL = 256
END = b" "  # no word holds a blank
LONGEST = 64
TOKENS_AT_ONCE = 1 << 19
SMOOTH = 0.5
_HASHES = ["h", "g"]


def tokens(text: str | None) -> list[bytes]:
    return [*(text or "").encode().lower().split(), END]


def _tokens_of(column: pa.Array) -> Iterator[list[bytes]]:
    """The same for each text of a column, whose bytes are taken as they are."""
    for data in column.cast(pa.binary()).to_pylist():
        own = data.lower().split()
        own.append(END)
        yield own


# ------------------------------------------------------------------ recursion


class Layout:
    """Sequences side by side: step t of all that are longer than t is one slice."""

    def __init__(self, sequences: list[np.ndarray]) -> None:
        lengths = np.array([len(s) for s in sequences])
        self.order = np.argsort(-lengths, kind="stable")
        lengths = lengths[self.order]
        self.active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
        self.offset = np.append(0, np.cumsum(self.active))
        self.flat = np.empty(self.offset[-1], np.int64)
        for place, at in enumerate(self.order.tolist()):
            own = sequences[at]
            self.flat[self.offset[: len(own)] + place] = own


class Model:
    """Start, transition and observation probabilities (observation by state)."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> None:
        self.start, self.move, self.emit = start, move, emit

    @classmethod
    def begin(cls, mass: np.ndarray) -> Model:
        """Frequencies shaken strongly and differently for each state, from a fixed seed; states that last."""
        shaken = mass[:, None] * (0.02 + np.random.default_rng(7).random((len(mass), STATES)) ** 4)
        move = np.full((STATES, STATES), 0.1 / STATES) + 0.9 * np.eye(STATES)
        return cls(np.full(STATES, 1 / STATES), move, shaken / shaken.sum(0))

    def forward(self, layout: Layout, keep: bool = False):
        """Natural log-likelihood of each sequence; with ``keep`` also what the backward pass needs."""
        seen = self.emit[layout.flat]
        log = np.zeros(layout.active[0])
        alphas = np.empty_like(seen) if keep else None
        scales = np.empty(len(seen)) if keep else None
        alpha = None
        for t, n in enumerate(layout.active.tolist()):
            at = slice(layout.offset[t], layout.offset[t + 1])
            alpha = (alpha[:n] @ self.move if t else self.start) * seen[at]
            scale = alpha.sum(1)
            alpha /= scale[:, None]
            log[:n] += np.log(scale)
            if keep:
                alphas[at], scales[at] = alpha, scale
        back = np.empty_like(log)
        back[layout.order] = log
        return (back, seen, alphas, scales) if keep else back

    def expect(self, layout: Layout) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected starts, moves, and state shares of every token (in ``layout.flat``'s order)."""
        _, seen, share, scales = self.forward(layout, keep=True)
        moves = np.zeros_like(self.move)
        seen /= scales[:, None]
        ahead = 0
        for t in range(len(layout.active) - 1, -1, -1):
            n = layout.active[t]
            at = slice(layout.offset[t], layout.offset[t + 1])
            beta = np.ones((n, STATES))
            if ahead:
                moves += share[at][:ahead].T @ weighted
                beta[:ahead] = weighted @ self.move.T
            weighted, ahead = seen[at] * beta, n
            share[at] *= beta
        return share[: layout.active[0]].sum(0), moves * self.move, share


def batches_of(sequences: list[np.ndarray]) -> Iterator[list[int]]:
    """Places of the sequences, longest first, cut where the tokens would be too many."""
    order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
    own: list[int] = []
    held = 0
    for i in order:
        if own and held + len(sequences[i]) > TOKENS_AT_ONCE:
            yield own
            own, held = [], 0
        own.append(i)
        held += len(sequences[i])
    if own:
        yield own


# ------------------------------------------------------------------ tables


def _prepared(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    held = F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5)) == 1, F.lit(False))
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("id"), held.alias("held"), F.xxhash64(text).alias("h"), F.xxhash64(F.lit(1), text).alias("g"), text.alias("text")
    )


def token_counts(prepared: DataFrame) -> DataFrame:
    """``token``, ``c``: occurrences in all training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own: Counter = Counter()
            for words in _tokens_of(batch.column(0)):
                own.update(words)
            yield pa.RecordBatch.from_arrays([pa.array(own.keys(), pa.binary()), pa.array(own.values(), pa.int64())], ["token", "c"])

    parts = map_batches(prepared.where("not held").select("text"), run, "token binary, c bigint")
    return parts.groupBy("token").agg(F.sum("c").alias("c"))


class Vocabulary:
    """The head tokens and the mass of every observation: fixed size, whatever the corpus."""

    def __init__(self, counts: DataFrame) -> None:
        total = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
        self.total, self.distinct = total["n"] or 0, total["v"]
        head = counts.where((F.col("c") > 1) & (F.octet_length("token") <= LONGEST)).orderBy(F.desc("c"), "token").limit(HEAD).toArrow()
        self.head: list[bytes] = head.column("token").to_pylist()
        self.head_counts = head.column("c").to_numpy().astype(float)
        self.in_tail = F.lit(True)
        if self.head:
            # Tokens too long for the head, and those after its last one, in the head's own order.
            c, last = self.head_counts[-1], self.head[-1]
            self.in_tail = (F.octet_length("token") > LONGEST) | (F.col("c") < c) | ((F.col("c") == c) & (F.col("token") > F.lit(last)))
        self.tail_counts, self.unknown = np.zeros(TAIL), np.full(TAIL, SMOOTH)
        tail = counts.where(self.in_tail).groupBy(F.pmod(F.crc32("token"), F.lit(TAIL)).alias("k"))
        for r in tail.agg(F.sum("c").alias("c"), F.count_if(F.col("c") == 1).alias("once")).collect():  # TAIL rows
            self.tail_counts[r["k"]], self.unknown[r["k"]] = r["c"], max(SMOOTH, r["once"])

    def mass(self) -> np.ndarray:
        """Share of each observation in the corpus; the tail's classes follow the head."""
        mass = np.concatenate([self.head_counts, self.tail_counts + self.unknown])
        return mass / mass.sum()


_PLACES: dict[int, dict[bytes, int]] = {}


def _places(sent) -> dict[bytes, int]:
    """Observation of each head token, built once for each Python worker."""
    if sent.id not in _PLACES:
        _PLACES.clear()
        _PLACES[sent.id] = {t: i for i, t in enumerate(sent.value)}
    return _PLACES[sent.id]


class _Head:
    """The broadcast head; its id names the worker's copy."""

    def __init__(self, sent, number: int, size: int) -> None:
        self.sent, self.id, self.size = sent, number, size

    @property
    def value(self) -> list[bytes]:
        return self.sent.value


def _encoded(prepared: DataFrame, head: _Head) -> DataFrame:
    """Each text as observations (four bytes each)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, size = _places(head).get, head.size
        for batch in batches:
            found = []
            for words in _tokens_of(batch.column("text")):
                own = [size + crc32(w) % TAIL if i is None else i for i, w in zip(map(place, words), words)]
                found.append(np.array(own, np.uint32).tobytes())
            kept = [batch.column(c) for c in ("id", "held", "h", "g")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found, pa.binary())], ["id", "held", "h", "g", "seen"])

    kind = prepared.schema["id"].dataType.simpleString()
    return map_batches(prepared, run, f"id {kind}, held boolean, h bigint, g bigint, seen binary")


def _tail(prepared: DataFrame, head: _Head) -> DataFrame:
    """Tokens outside the head by text, and one row without a token for each row of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = _places(head)
        for batch in batches:
            texts, own_tokens, own_counts = [], [], []
            for i, words in enumerate(_tokens_of(batch.column("text"))):
                own = Counter(filterfalse(place.__contains__, words))
                texts += [i] * (len(own) + 1)
                own_tokens += [None, *own.keys()]
                own_counts += [1, *own.values()]
            at = pa.array(texts, pa.int64())
            columns = [batch.column(c).take(at) for c in _HASHES]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(own_tokens, pa.binary()), pa.array(own_counts, pa.int64())], [*_HASHES, "token", "n"]
            )

    return map_batches(prepared.select(*_HASHES, "text"), run, "h bigint, g bigint, token binary, n bigint")


def _sequences(column) -> list[np.ndarray]:
    return [np.frombuffer(x.as_py(), np.uint32) for x in column]


def train(encoded: DataFrame, vocabulary: Vocabulary, work: Workspace) -> Model:
    """``ROUNDS`` rounds of Baum-Welch over all training texts."""
    model = Model.begin(vocabulary.mass())
    size = len(model.emit)
    mass = vocabulary.mass()[:, None]
    context = encoded.sparkSession.sparkContext
    names = ["row", *(f"s{k}" for k in range(STATES))]
    for round_ in range(ROUNDS):
        sent = context.broadcast((model.start, model.move, model.emit.astype(np.float32)))

        def expect(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            start, move, emit = sent.value
            own = Model(start, move, emit)
            counts = np.zeros((size + STATES + 1, STATES))
            for batch in batches:
                sequences = _sequences(batch.column(0))
                for places in batches_of(sequences):
                    layout = Layout([sequences[i] for i in places])
                    starts, moves, share = own.expect(layout)
                    for k in range(STATES):
                        counts[:size, k] += np.bincount(layout.flat, weights=share[:, k], minlength=size)
                    counts[size : size + STATES] += moves
                    counts[-1] += starts
            rows = np.flatnonzero(counts.any(1))
            columns = [pa.array(rows), *(pa.array(counts[rows, k].astype(np.float32)) for k in range(STATES))]
            yield pa.RecordBatch.from_arrays(columns, names)

        parts = map_batches(encoded.where("not held").select("seen"), expect, "row bigint, " + ", ".join(f"{n} float" for n in names[1:]))
        summed = work.store(parts.groupBy("row").agg(*[F.sum(n).alias(n) for n in names[1:]]), f"round-{round_}")
        summed = summed.toArrow()  # as many rows as the tables have
        work.drop(f"round-{round_}")
        counts = np.zeros((size + STATES + 1, STATES))
        counts[summed.column("row").to_numpy()] = np.stack([summed.column(n).to_numpy() for n in names[1:]], 1)
        kinds = -np.expm1(-counts[:size]).sum(0)  # different observations of a state, the rarely expected ones in part
        emit = counts[:size] + (kinds + SMOOTH) * mass
        move = counts[size : size + STATES] + SMOOTH
        start = counts[-1] + SMOOTH
        model = Model(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))
    return model


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train on the rows that are not held out and score all rows."""
    spark = docs.sparkSession
    work = Workspace(spark, "hmm")
    prepared = _prepared(docs, id_col, text_col)
    counts = work.store(token_counts(prepared), "counts")
    vocabulary = Vocabulary(counts)
    size, total, distinct = len(vocabulary.head), vocabulary.total, vocabulary.distinct
    sent = spark.sparkContext.broadcast(vocabulary.head)  # HEAD tokens at most
    head = _Head(sent, hash(work.folder), size)
    encoded = work.store(_encoded(prepared, head), "encoded")
    model = train(encoded, vocabulary, work)

    # Tokens outside the head: their counts by a join, then sums by text.
    below = total + SMOOTH * (distinct + 1)
    classes = spark.createDataFrame(
        [(k, float(u), float(n + u)) for k, (n, u) in enumerate(zip(vocabulary.tail_counts, vocabulary.unknown, strict=True))],
        "k long, unknown double, of_class double",
    )
    c = F.coalesce(F.col("c"), F.lit(0))
    part = F.coalesce(F.col("c").cast("double"), F.col("unknown"))
    rows = _tail(prepared, head).join(counts.where(vocabulary.in_tail), "token", "left")
    rows = rows.withColumn("k", F.pmod(F.crc32("token"), F.lit(TAIL))).join(F.broadcast(classes), "k", "left")  # TAIL rows
    word = F.col("token").isNotNull()
    tail = work.store(
        rows.groupBy(*_HASHES).agg(
            F.sum(F.when(~word, F.col("n"))).alias("copies"),
            F.sum(F.when(word & F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("known"),
            F.sum(F.when(word, F.col("n") * F.log10((c + F.lit(SMOOTH)) / F.lit(below))).otherwise(0.0)).alias("base"),
            F.sum(F.when(word, F.col("n") * F.log10(part / F.col("of_class"))).otherwise(0.0)).alias("share"),
        ),
        "tail",
    )
    tables = spark.sparkContext.broadcast(
        (model.start, model.move, model.emit, np.append(np.log10((vocabulary.head_counts + SMOOTH) / below), np.zeros(TAIL)))
    )
    names = ["id", "held_out", "h", "g", "n_tokens", "head_known", "head_base", "states"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, move, emit, base = tables.value
        own = Model(start, move, emit)
        for batch in batches:
            sequences = _sequences(batch.column("seen"))
            logs = np.zeros(len(sequences))
            for places in batches_of(sequences):
                logs[places] = own.forward(Layout([sequences[i] for i in places]))
            known = [int((s < size).sum()) for s in sequences]
            bases = [float(base[s].sum()) for s in sequences]
            columns = [batch.column(x) for x in ("id", "held", "h", "g")]
            columns += [pa.array([len(s) for s in sequences], pa.int64()), pa.array(known, pa.int64()), pa.array(bases, pa.float64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(logs / np.log(10))], names)

    kind = encoded.schema["id"].dataType.simpleString()
    scored = map_batches(
        encoded, run,
        f"id {kind}, held_out boolean, h bigint, g bigint, n_tokens bigint, head_known bigint, head_base double, states double",
    )
    work.drop("counts")
    return scored.join(tail, _HASHES).select(
        F.col("id").alias(id_col), "held_out", "n_tokens",
        (F.col("head_known") + F.expr("known div copies")).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("head_base") + F.col("base") / F.col("copies")).alias("base_score"),
        (F.col("states") + F.col("share") / F.col("copies")).alias("score"),
    )
