"""SimHash near-dedup by the general pigeonhole principle.

A fingerprint has a bit where more than half of the text's shingle hashes have it. Two
fingerprints link if at most ``DISTANCE`` bits differ. The 64 bits are grouped into ``GROUPS``
parts, correlated bits together. If a pair is within the distance, then for every choice of
thresholds t_i >= -1 with sum DISTANCE - GROUPS + 1, some part i differs in at most t_i bits
(-1: the part is not probed). Each fingerprint chooses its thresholds by dynamic programming on
the candidates to expect: counts of every half part's values are exact, distances within the
halves are taken as independent. It then probes an index of part values and verifies.

A bucket of more than ``CROWDED`` fingerprints does not pair up. Its members, and whoever probes
it, are linked exactly by another rule: fingerprints that share a neighbour at distance one (or
are one) are within distance two, and every pair within two shares one. Each member sends its 65
neighbours, and those who share one are linked to the smallest.

Defined results: a null or wordless text has fingerprint zero and is linked like any other;
repeated rows give repeated results; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations, product, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from deskrisk.llm.components import components
from deskrisk.llm.workspace import Workspace, map_batches

SHINGLE = 3
DISTANCE = 2
GROUPS = 3
CROWDED = 65
_CHUNK = 1 << 16
_PLACES = np.arange(8, dtype=np.int64) * 256
# Bits of each byte value, lowest first.
_BITS = (np.arange(256)[:, None] >> np.arange(8)) & 1


def fingerprint(text: str | None) -> int:
    words = (text or "").encode().lower().split()  # bytes: only A-Z change, only ASCII blanks split
    if not words:
        return 0
    total = max(1, len(words) - SHINGLE + 1)
    ones = np.zeros((8, 8), np.int64)
    for at in range(0, total, _CHUNK):
        part = words[at : at + _CHUNK + SHINGLE - 1]
        count = max(1, len(part) - SHINGLE + 1)
        shingles = map(b" ".join, zip(*[part[k:] for k in range(SHINGLE)])) if len(part) >= SHINGLE else [b" ".join(part)]
        hashes = np.fromiter(map(xxh64_intdigest, shingles, repeat(42)), np.uint64, count)
        byte_values = hashes.view(np.uint8).reshape(-1, 8) + _PLACES
        ones += np.bincount(byte_values.ravel(), minlength=2048).reshape(8, 256) @ _BITS
    bits = (2 * ones.ravel() > total).astype(np.uint64)
    return int((bits << np.arange(64, dtype=np.uint64)).sum())


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and ``fp`` (the 64 bits as a signed long) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py()) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], ["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(id_col, text_col), run, f"id {kind}, fp bigint")


def _unpacked(values: np.ndarray) -> np.ndarray:
    return ((values.view(np.uint64)[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(np.float64)


def correlated_groups(prints: DataFrame) -> list[list[int]]:
    """Bits in ``GROUPS`` parts: each begins with the strongest pair left and takes the bits closest to it."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((65, 65))
        for batch in batches:
            bits = _unpacked(batch.column(0).to_numpy(zero_copy_only=False))
            bits = np.hstack([bits, np.ones((len(bits), 1))])
            total += bits.T @ bits
        cells = np.arange(65 * 65)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total.ravel())], ["cell", "n"])

    rows = map_batches(prints.select("fp"), products, "cell bigint, n double").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    table = np.zeros(65 * 65)  # 65 x 65 sums, whatever the input
    for r in rows:
        table[r["cell"]] = r["n"]
    table = table.reshape(65, 65)
    n = max(1.0, table[64, 64])
    mean = table[64, :64] / n
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-9))
    strength = np.abs((table[:64, :64] / n - np.outer(mean, mean)) / np.outer(spread, spread))
    np.fill_diagonal(strength, -1)
    free, groups = set(range(64)), []
    for k in range(GROUPS):
        size = len(free) // (GROUPS - k)
        pairs = [(strength[a, b], -a, -b) for a, b in combinations(sorted(free), 2)]
        _, a, b = max(pairs)
        group = [-a, -b]
        while len(group) < size:
            group.append(max(sorted(free - set(group)), key=lambda x, g=group: strength[x, g].mean()))
        groups.append(sorted(group[:size]))
        free -= set(group)
    return groups


def _gather(values: np.ndarray, bits: list[int]) -> np.ndarray:
    """The given bits of each value, packed."""
    values = values.view(np.uint64)
    out = np.zeros(len(values), np.int64)
    for place, bit in enumerate(bits):
        out |= (((values >> np.uint64(bit)) & np.uint64(1)) << np.uint64(place)).astype(np.int64)
    return out


class Allocation:
    """Thresholds by dynamic programming on expected candidates; of fixed size, whatever the input."""

    def __init__(self, prints: DataFrame, groups: list[list[int]]) -> None:
        self.groups = groups
        self.halves = [(g[: len(g) // 2], g[len(g) // 2 :]) for g in groups]
        flat = [h for pair in self.halves for h in pair]

        def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts = [np.zeros(1 << len(h), np.int64) for h in flat]
            for batch in batches:
                fps = batch.column(0).to_numpy(zero_copy_only=False)
                for c, h in zip(counts, flat, strict=True):
                    c += np.bincount(_gather(fps, h), minlength=len(c))
            for k, c in enumerate(counts):
                at = np.flatnonzero(c)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k)), pa.array(at), pa.array(c[at])], ["half", "value", "n"])

        rows = map_batches(prints.select("fp"), values, "half bigint, value bigint, n bigint")
        counts = [np.zeros(1 << len(h)) for h in flat]  # 2 * GROUPS tables of 2^11 entries at most
        for r in rows.groupBy("half", "value").agg(F.sum("n").alias("n")).collect():
            counts[r["half"]][r["value"]] = r["n"]
        self.total = max(1.0, counts[0].sum())
        self.near = [self._within(c) for c in counts]

    @staticmethod
    def _within(counts: np.ndarray) -> np.ndarray:
        """For each value, how many fingerprints have a value at distance 0, 1 and 2."""
        bits = len(counts).bit_length() - 1
        all_values = np.arange(len(counts))
        one = sum(counts[all_values ^ (1 << a)] for a in range(bits))
        two = sum(counts[all_values ^ (1 << a) ^ (1 << b)] for a, b in combinations(range(bits), 2))
        return np.stack([counts, one, two])

    def thresholds(self, fps: np.ndarray) -> np.ndarray:
        """Row by row the cheapest thresholds (-1 to DISTANCE for each part)."""
        costs = []
        for g, (low, high) in enumerate(self.halves):
            a = self.near[2 * g][:, _gather(fps, low)] / self.total
            b = self.near[2 * g + 1][:, _gather(fps, high)]
            at = [sum(a[i] * b[d - i] for i in range(d + 1)) for d in range(DISTANCE + 1)]
            width = len(low) + len(high)
            probes = np.cumsum([1, width, width * (width - 1) // 2])
            costs.append(np.vstack([np.zeros(len(fps)), np.cumsum(at, axis=0) + probes[:, None]]))
        # best[s]: cheapest way for the parts so far to have thresholds of sum s - (parts so far).
        best = {0: (np.zeros(len(fps)), np.zeros((len(fps), 0), np.int64))}
        for cost in costs:
            following: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            for (s, (spent, chosen)), t in product(best.items(), range(DISTANCE + 2)):
                price = spent + cost[t]
                path = np.hstack([chosen, np.full((len(fps), 1), t - 1)])
                if s + t in following:
                    old, kept = following[s + t]
                    better = price < old
                    price, path = np.where(better, price, old), np.where(better[:, None], path, kept)
                following[s + t] = (price, path)
            best = following
        return best[DISTANCE + 1][1]

    def probes(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Part, part value and fingerprint of every probe."""
        chosen = self.thresholds(fps)
        parts, values, own = [], [], []
        for g, bits in enumerate(self.groups):
            base = _gather(fps, bits)
            for radius in range(DISTANCE + 1):
                rows = chosen[:, g] >= radius
                if rows.any():
                    for flips in combinations(range(len(bits)), radius):
                        values.append(base[rows] ^ sum(1 << f for f in flips))
                        own.append(fps[rows])
                        parts.append(np.full(rows.sum(), g))
        return tuple(np.concatenate(x) if x else np.empty(0, np.int64) for x in (parts, values, own))


def links(prints: DataFrame, work: Workspace) -> DataFrame:
    """``a``, ``b``: enough links between distinct fingerprints to give the right components."""
    groups = correlated_groups(prints)
    allocation = Allocation(prints, groups)

    def emit(batches: Iterator[pa.RecordBatch], probing: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            if probing:
                part, value, own = allocation.probes(fps)
            else:
                part = np.repeat(np.arange(len(groups)), len(fps))
                value = np.concatenate([_gather(fps, g) for g in groups])
                own = np.tile(fps, len(groups))
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(value), pa.array(own)], ["part", "value", "fp"])

    kind = "part bigint, value bigint, fp bigint"
    index = map_batches(prints.select("fp"), partial(emit, probing=False), kind)
    probes = map_batches(prints.select("fp"), partial(emit, probing=True), kind)
    crowded = work.store(index.groupBy("part", "value").count().where(F.col("count") > CROWDED).drop("count"), "crowded")

    candidates = (
        index.join(crowded, ["part", "value"], "left_anti").withColumnRenamed("fp", "b")
        .join(probes.withColumnRenamed("fp", "a"), ["part", "value"])
        .where((F.col("a") > F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE))
        .select("a", "b").distinct()
    )
    in_crowd = (
        index.union(probes).join(crowded, ["part", "value"], "left_semi").select("fp").distinct()
    )
    flips = F.array(F.lit(0).cast("long"), *[F.shiftleft(F.lit(1).cast("long"), k) for k in range(64)])
    neighbours = in_crowd.select("fp", F.explode(F.transform(flips, lambda f: F.col("fp").bitwiseXOR(f))).alias("shared"))
    least = neighbours.groupBy("shared").agg(F.min("fp").alias("b"), F.max("fp").alias("most")).where("b < most")
    crowd = neighbours.join(least, "shared").where("fp <> b").select(F.col("fp").alias("a"), "b").distinct()
    return candidates.union(crowd)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``fingerprint`` (16 hex digits) and ``component_id`` (smallest id reachable)."""
    work = Workspace(docs.sparkSession, "simhash")
    own = work.store(fingerprints(docs, id_col, text_col), "fingerprints")
    first = work.store(own.groupBy("fp").agg(F.min("id").alias("first")), "distinct")
    found = work.store(links(first, work), "links")
    roots = work.store(components(found, work), "roots")
    work.drop("links", "crowded")
    # Smallest id of each component; a fingerprint without links is its own.
    rooted = first.join(roots, first["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    by_print = rooted.join(least, "root").select("fp", "component_id")
    return own.join(by_print, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
