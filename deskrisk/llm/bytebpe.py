"""Byte-level BPE by a rank queue: buckets of positions under a hierarchical bitmap.

The text is split by the tokenizer's pattern. A split piece that is a token is that token;
in every other piece the adjacent pair of lowest rank merges first, the leftmost among equals.

Pieces lie one after another in one linked list. Each merge rank has a bucket of positions, and
a bitmap of three levels tells which buckets hold any: the lowest set bit of each level leads to
the next rank in constant time. Entries are never removed from a bucket; one whose pair has
changed since is stale and skipped. A piece of n bytes takes O(n) pushes, so that very long
pieces cost no more for each byte than short ones.

Defined results: a null text is the empty text and has no tokens; repeated rows give repeated
results; an empty table gives none; columns other than the id and the text are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from deskrisk.llm.workspace import map_batches

# Distinct pieces a Python worker remembers; beyond it the memory is emptied and filled anew.
REMEMBERED_PIECES = 600_000
# Bytes of pieces in one linked list.
QUEUE_BYTES = 1 << 20
# Longer texts are split piecewise, so that their list of pieces is never whole in memory.
LONG_TEXT = 1 << 20
PIECES_AT_ONCE = 1 << 16
# Characters of texts whose new pieces share one queue.
TOGETHER = 1 << 23


class RankQueue:
    """Buckets of list positions by merge rank; ``first`` is the lowest rank that has any."""

    def __init__(self, ranks: int, filled: dict[int, list[int]]) -> None:
        self.buckets: dict[int, list[int]] = filled
        self.low = [0] * (ranks // 64 + 1)
        self.middle = [0] * (ranks // 4096 + 1)
        self.top = 0
        for rank in filled:
            self._mark(rank)

    def _mark(self, rank: int) -> None:
        self.low[rank >> 6] |= 1 << (rank & 63)
        self.middle[rank >> 12] |= 1 << (rank >> 6 & 63)
        self.top |= 1 << (rank >> 12)

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.buckets[rank] = [position]
            self._mark(rank)
        else:
            bucket.append(position)

    def first(self) -> int:
        """The lowest rank with a position, or -1."""
        if not self.top:
            return -1
        a = (self.top & -self.top).bit_length() - 1
        word = self.middle[a]
        b = a << 6 | (word & -word).bit_length() - 1
        word = self.low[b]
        return b << 6 | (word & -word).bit_length() - 1

    def take(self, rank: int) -> list[int]:
        """Empty a bucket and return its positions."""
        positions = self.buckets.pop(rank)
        self.low[rank >> 6] &= ~(1 << (rank & 63))
        if not self.low[rank >> 6]:
            self.middle[rank >> 12] &= ~(1 << (rank >> 6 & 63))
            if not self.middle[rank >> 12]:
                self.top &= ~(1 << (rank >> 12))
        return positions


@dataclass
class _Symbols:
    """A linked list of symbols: token, neighbours, and rank of the merge with the next one (or -1)."""

    token: np.ndarray
    before: np.ndarray
    after: np.ndarray
    rank: np.ndarray


def _by_rank(ranks: np.ndarray) -> dict[int, list[int]]:
    order = np.argsort(ranks, kind="stable")
    order = order[np.searchsorted(ranks[order], 0) :]
    found, starts = np.unique(ranks[order], return_index=True)
    return dict(zip(found.tolist(), map(np.ndarray.tolist, np.split(order, starts[1:])), strict=False))


class _Partners:
    """For each token, the tokens it merges with in ascending order, and the ranks of the merges: slices of two arrays."""

    def __init__(self, own: np.ndarray, other: np.ndarray, rank: np.ndarray, size: int) -> None:
        order = np.lexsort((other, own))
        self.other, self.rank = other[order], rank[order]
        self.start = np.searchsorted(own[order], np.arange(size + 1))

    def of(self, token: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(self.start[token], self.start[token + 1])
        return self.other[part], self.rank[part]


class Codec:
    """Encoder and decoder over one rank file (token in base64, rank)."""

    def __init__(self, rank_file: bytes, pattern: str) -> None:
        self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_file.splitlines())}
        self.size = max(self.rank.values()) + 1
        self.bytes_of = {r: token for token, r in self.rank.items()}
        self.digits = {r: str(r) for r in self.bytes_of}
        self.byte_ids = np.array([self.rank[bytes([b])] for b in range(256)])
        # Merges (left, right, rank): every way to cut a token into two tokens. Held in arrays, as every worker has them.
        flat = array("q")
        for token, rank in self.rank.items():
            for cut in range(1, len(token)):
                left, right = self.rank.get(token[:cut]), self.rank.get(token[cut:])
                if left is not None and right is not None:
                    flat.extend((left, right, rank))
        left, right, merged = np.frombuffer(flat, np.int64).reshape(-1, 3).T if len(flat) else np.empty((3, 0), np.int64)
        self.right_of = _Partners(left, right, merged, self.size)
        self.left_of = _Partners(right, left, merged, self.size)
        # Tokens that can merge further at a rank below their own.
        self.falls = np.zeros(self.size, bool)
        self.falls[left[merged < left]] = True
        self.falls[right[merged < right]] = True
        self.find = regex.compile(pattern)
        # Packed ids (four bytes each) by piece.
        self.known: dict[str, bytes] = {}
        # Rank of the merge of two bytes, by their ids; -1 where there is none.
        most = self.byte_ids.max() + 1
        self.byte_pairs = np.full((most, most), -1)
        single = np.isin(left, self.byte_ids) & np.isin(right, self.byte_ids)
        self.byte_pairs[left[single], right[single]] = merged[single]

    def pieces(self, text: str) -> Iterator[list[str]]:
        """The pattern's matches, in lists of bounded length."""
        if len(text) <= LONG_TEXT:
            yield self.find.findall(text)
            return
        matches = self.find.finditer(text)
        while part := [m.group() for m in islice(matches, PIECES_AT_ONCE)]:
            yield part

    def learn(self, pieces: Iterable[str]) -> None:
        """Encode the pieces that are not known yet."""
        missing = set(pieces).difference(self.known)
        if len(self.known) + len(missing) > REMEMBERED_PIECES:
            self.known.clear()
            missing = set(pieces)
        waiting, held = [], 0
        for piece in missing:
            data = piece.encode()
            rank = self.rank.get(data)
            if rank is not None:
                self.known[piece] = array("I", (rank,)).tobytes()
                continue
            waiting.append((piece, data))
            held += len(data)
            if held >= QUEUE_BYTES:
                self._merge(waiting)
                waiting, held = [], 0
        if waiting:
            self._merge(waiting)

    def _merge(self, waiting: list[tuple[str, bytes]]) -> None:
        """Merge all waiting pieces in one linked list, one bucket after another."""
        lengths = np.fromiter((len(data) for _, data in waiting), np.int64, len(waiting))
        ends = np.cumsum(lengths)
        token = self.byte_ids[np.frombuffer(b"".join(data for _, data in waiting), np.uint8)]
        before, after = np.arange(-1, len(token) - 1), np.arange(1, len(token) + 1)
        after[ends - 1] = -1
        before[ends - lengths] = -1
        state = _Symbols(token, before, after, self._first_ranks(token, ends))
        owner = np.repeat(np.arange(len(ends)), lengths)
        queue = RankQueue(self.size, _by_rank(state.rank))
        while (rank := queue.first()) >= 0:
            found = queue.take(rank)
            at = np.unique(np.array(found)) if len(found) > 1 else np.array(found)
            at = at[state.rank[at] == rank]  # the others are stale
            if self.falls[rank] and len(at) > 1:
                # A merge can make one of lower rank possible in its piece, which then goes first.
                own = owner[at]
                again = np.append(False, own[1:] == own[:-1])
                for rest in at[again].tolist():
                    queue.push(rank, rest)
                at = at[~again]
            if len(at):
                self._merge_bucket(state, queue, rank, at)
        alive = token >= 0
        packed, start = token[alive].astype(np.uint32).tobytes(), 0
        for (piece, _), end in zip(waiting, (4 * np.cumsum(alive)[ends - 1]).tolist(), strict=True):
            self.known[piece] = packed[start:end]
            start = end

    def _merge_bucket(self, state: _Symbols, queue: RankQueue, rank: int, at: np.ndarray) -> None:
        gone = state.after[at]
        overlap = gone[:-1] == at[1:]
        if overlap.any():  # a run of equal symbols: from its left end every second pair
            place = np.arange(len(at))
            head = np.maximum.accumulate(np.where(np.append(False, overlap), 0, place))
            kept = (place - head) % 2 == 0
            at, gone = at[kept], gone[kept]
        following = state.after[gone]
        state.token[at], state.token[gone], state.rank[gone] = rank, -1, -1
        state.after[at] = following
        linked = following >= 0
        state.before[following[linked]] = at[linked]
        state.rank[at] = -1
        for side, table in ((linked, self.right_of), (state.before[at] >= 0, self.left_of)):
            partners, ranks = table.of(rank)
            own = at[side] if table is self.right_of else state.before[at[side]]
            if not len(partners):
                state.rank[own] = -1
                continue
            other = state.token[following[side]] if table is self.right_of else state.token[own]
            place = np.minimum(np.searchsorted(partners, other), len(partners) - 1)
            new = np.where(partners[place] == other, ranks[place], -1)
            state.rank[own] = new
            for r, i in zip(new.tolist(), own.tolist(), strict=True):
                if r >= 0:
                    queue.push(r, i)

    def _first_ranks(self, token: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Rank of the merge of each byte with the next one of its piece, else -1."""
        ranks = np.append(self.byte_pairs[token[:-1], token[1:]], -1)
        ranks[ends - 1] = -1
        return ranks

    def packed(self, text: str | None) -> Iterator[np.ndarray]:
        """The ids of a text, in arrays of bounded length."""
        for part in self.pieces(text or ""):
            self.learn(part)
            yield np.frombuffer(b"".join(map(self.known.__getitem__, part)), np.uint32)

    def encode(self, text: str | None) -> list[int]:
        return [i for ids in self.packed(text) for i in ids.tolist()]

    def encode_together(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text; what is new in them is merged in one queue."""
        # Every distinct piece is held once, however often it occurs.
        shared: dict[str, str] = {}
        parts = [list(map(shared.setdefault, part, part)) for part in map(self.find.findall, texts)]
        self.learn(shared)
        for part in parts:
            yield np.frombuffer(b"".join(map(self.known.__getitem__, part)), np.uint32)

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of a sequence of ids."""
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def digests(self, arrays: Iterable[np.ndarray]) -> tuple[int, str, str]:
        """Number of tokens, digest of the written ids, digest of the decoded bytes."""
        written, decoded, n = hashlib.sha256(), hashlib.sha256(), 0
        for ids in (a.tolist() for a in arrays if len(a)):
            written.update(((" " if n else "") + " ".join(map(self.digits.__getitem__, ids))).encode())
            decoded.update(self.decode(ids))
            n += len(ids)
        return n, written.hexdigest(), decoded.hexdigest()

    def round_trips(self, texts: list[str | None]) -> Iterator[tuple[int, str, str]]:
        """``digests`` of each text. Texts go through the queue together, long ones alone."""
        waiting: list[str] = []
        held = 0
        for text in texts:
            text = text or ""
            if held + len(text) > TOGETHER and waiting:
                yield from (self.digests([ids]) for ids in self.encode_together(waiting))
                waiting, held = [], 0
            if len(text) > LONG_TEXT:
                yield self.digests(self.packed(text))
                continue
            waiting.append(text)
            held += len(text)
        yield from (self.digests([ids]) for ids in self.encode_together(waiting))


@lru_cache(maxsize=2)
def codec(rank_file: bytes, pattern: str) -> Codec:
    """One codec per Python worker."""
    return Codec(rank_file, pattern)


def _vocabulary(docs: DataFrame, path: str):
    """The rank file, a fixed part of the model, sent once to every executor."""
    with open(path, "rb") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``ids``, the token ids of each text, one row for each input row."""
    ranks = _vocabulary(docs, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks.value, pattern)
        for batch in batches:
            ids = [own.encode(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], [id_col, "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(id_col, text_col), run, f"`{id_col}` {kind}, ids array<int>")


def decode(tokens: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """``id_col`` and ``text`` from the ids that ``encode`` gave."""
    ranks = _vocabulary(tokens, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks.value, pattern)
        for batch in batches:
            texts = [own.decode(t.as_py() or []).decode(errors="replace") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [id_col, "text"])

    kind = tokens.schema[id_col].dataType.simpleString()
    return map_batches(tokens.select(id_col, "ids"), run, f"`{id_col}` {kind}, text string")


def round_trip(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text, decode the ids again, and return the digests of both."""
    ranks = _vocabulary(docs, vocabulary)
    names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks.value, pattern)
        for batch in batches:
            rows = list(own.round_trips(batch.column(1).to_pylist()))
            n, written, decoded = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(written, pa.string()), pa.array(decoded, pa.string())],
                names,
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(id_col, text_col), run, f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
