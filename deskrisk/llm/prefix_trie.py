"""A trie of conversation prefixes, in balanced parentheses, shard by shard.

A conversation is the sequence of the digests of its turns (role and text, 128 bits), written as
one binary value. All are sorted by it and then by id, and dealt in ranges: a shard holds
neighbours in the order of the trie, however many are alike. In a shard, the trie is a string of
parentheses: what a row shares with the row before stays open, the rest of that one closes, its own
rest opens. Over the running excess of open ones lies a tree of block minima; ``close`` finds with
it where a node's subtree ends. From there on, everything is a difference of two cumulative
arrays: members (conversations that end in the subtree), leaves (the rank of pairs ``()``), savings.

Only nodes on a shard's first and last path can go on in another shard. Such spines, two a shard,
meet in one task: it builds the trie of the spines alone, adds up what the shards had under each
spine node, and sums over subtrees again. Its input grows with shards and depth, not with
conversations. Members that end on spines are brought together by node for their digest, which
is of one sequence and so reads a node's ids in one task, sorted, a batch at a time.

Defined results: rows without a conversation id are left out; null role or text is the empty text;
turns with one number go by role and then by digest; repeated rows are repeated turns; an empty
table gives no nodes, not even a root; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskrisk.llm.workspace import Workspace, map_batches

# How conversations are rebuilt, and the digest of no members.
FAMILY = 5
MOST_SHARED = 9
NO_MEMBERS = hashlib.sha256(b"").hexdigest()

DIGEST = 16
BLOCK = 256
_NOBODY = np.iinfo(np.int64).max
_ROWS = 1 << 16


def paths(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``path`` (joined digests of its turns) and ``sizes`` (bytes of their texts), as stored."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.left(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), F.lit(2 * DIGEST))
    turn = F.struct("turn", role.alias("role"), digest.alias("digest"), F.octet_length(text).alias("size"))
    turns = conversations.where("conv_id is not null").select("conv_id", turn.alias("t"))
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns")).select(
        "conv_id", F.transform("turns", lambda t: t["digest"]).alias("digests"), F.transform("turns", lambda t: t["size"]).alias("sizes")
    )


def rebuilt(own: DataFrame) -> DataFrame:
    """Each conversation begins with turns of its family's first one; see ``FAMILY`` and ``MOST_SHARED``."""
    first = own.where(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("family"), F.slice("digests", 1, MOST_SHARED).alias("d"), F.slice("sizes", 1, MOST_SHARED).alias("s")
    )
    shared = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_SHARED).cast("int")
    joined = own.withColumns({"family": F.col("conv_id") - F.col("conv_id") % FAMILY, "shared": shared}).join(first, "family", "left")

    def both(head: str, tail: str, kind: str) -> Column:
        begin = F.slice(F.coalesce(head, F.array().cast(kind)), F.lit(1), F.col("shared"))
        return F.concat(begin, F.slice(tail, F.col("shared") + 1, F.greatest(F.size(tail), F.lit(1))))

    return joined.select(
        "conv_id", F.unhex(F.array_join(both("d", "digests", "array<string>"), "")).alias("path"),
        both("s", "sizes", "array<int>").alias("sizes"),
    )


class Excess:
    """Running excess of open parentheses, with a heap of block minima over it."""

    def __init__(self, opening: np.ndarray) -> None:
        self.values = np.cumsum(np.where(opening, 1, -1))
        blocks = -(-len(self.values) // BLOCK)
        self.leaves = 1 << max(0, blocks - 1).bit_length()
        padded = np.full(self.leaves * BLOCK, np.iinfo(np.int64).max)
        padded[: len(self.values)] = self.values
        self.heap = np.empty(2 * self.leaves, np.int64)
        self.heap[self.leaves :] = padded.reshape(-1, BLOCK).min(axis=1)
        low = self.leaves
        while low > 1:
            self.heap[low // 2 : low] = self.heap[low : 2 * low].reshape(-1, 2).min(axis=1)
            low //= 2
        self.values = padded

    def _scan(self, at: np.ndarray, target: np.ndarray, found: np.ndarray, live: np.ndarray) -> np.ndarray:
        """Search on from ``at`` up to the block's end; returns the queries that are still open."""
        beyond = []
        while live.size:
            hit = self.values[at] <= target[live]
            found[live[hit]] = at[hit]
            live, at = live[~hit], at[~hit] + 1
            end = at % BLOCK == 0
            beyond.append(live[end])
            live, at = live[~end], at[~end]
        return np.concatenate(beyond) if beyond else live

    def close(self, opens: np.ndarray) -> np.ndarray:
        """For each open parenthesis the place of the one that closes it."""
        target, found = self.values[opens] - 1, np.full(len(opens), -1)
        inside = (opens + 1) % BLOCK != 0
        late = self._scan(opens[inside] + 1, target, found, np.flatnonzero(inside))
        live = np.concatenate([late, np.flatnonzero(~inside)])
        node = self.leaves + opens[live] // BLOCK + 1
        while (far := self.heap[node] > target[live]).any():  # up and to the right, to a block that goes low enough
            node[far] = np.where(node[far] % 2 == 1, (node[far] + 1) // 2, node[far] + 1)
        while (high := node < self.leaves).any():
            left = 2 * node[high]
            node[high] = np.where(self.heap[left] <= target[live[high]], left, left + 1)
        self._scan((node - self.leaves) * BLOCK, target, found, live)
        return found


@dataclass
class Trie:
    """Nodes in preorder, the root first, of sorted paths."""

    first: np.ndarray  # each row's first new node
    shared: np.ndarray  # turns each row shares with the row before
    end: np.ndarray  # each row's last node
    depth: np.ndarray
    size: np.ndarray  # nodes of the subtree
    parent: np.ndarray  # the root's is -1

    def below(self, own: np.ndarray) -> np.ndarray:
        """Sums over subtrees, as differences of one cumulative array."""
        total = np.concatenate([np.zeros(1, np.int64), np.cumsum(own)])
        at = np.arange(len(own))
        return total[at + self.size] - total[at]

    def least(self, own: np.ndarray) -> np.ndarray:
        """Minima over subtrees, from the deepest nodes up."""
        least = own.copy()
        order = np.argsort(-self.depth, kind="stable")
        for nodes in np.split(order, np.flatnonzero(np.diff(self.depth[order])) + 1)[:-1]:
            np.minimum.at(least, self.parent[nodes], least[nodes])
        return least


def build(digests: np.ndarray, lengths: np.ndarray) -> Trie:
    """The trie of paths given one after another (``digests``: two numbers a turn), sorted."""
    n = len(lengths)
    offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum(lengths)])
    shared = np.zeros(n, np.int64)
    common = np.minimum(lengths[1:], lengths[:-1])
    rows = np.flatnonzero(common) + 1
    if rows.size:
        counts = common[rows - 1]
        begin = np.concatenate([np.zeros(1, np.int64), np.cumsum(counts)[:-1]])
        k = np.arange(counts.sum()) - np.repeat(begin, counts)
        unlike = (digests[np.repeat(offsets[rows], counts) + k] != digests[np.repeat(offsets[rows - 1], counts) + k]).any(axis=1)
        shared[rows] = np.minimum.reduceat(np.where(unlike, k, np.repeat(counts, counts)), begin)
    new = lengths - shared
    first = 1 + np.concatenate([np.zeros(1, np.int64), np.cumsum(new)[:-1]])
    closing = np.concatenate([np.zeros(1, np.int64), lengths[:-1]])
    closing[1:] -= shared[1:]
    runs = np.concatenate([[1], np.column_stack([closing, new]).ravel(), [lengths[-1] + 1]])
    opening = np.repeat(np.concatenate([[True], np.tile([False, True], n), [False]]), runs)

    opens = np.flatnonzero(opening)
    closes = Excess(opening).close(opens)
    nodes = len(opens)
    depth = np.cumsum(np.where(opening, 1, -1))[opens] - 1
    owner = np.empty(len(opening), np.int64)
    owner[closes] = np.arange(nodes)
    eldest = np.ones(nodes, bool)
    eldest[1:] = opening[opens[1:] - 1]
    pointer = np.where(eldest, np.arange(nodes), owner[np.maximum(opens - 1, 0)])  # else: the sibling before
    while not eldest[pointer].all():
        pointer = pointer[pointer]
    end = np.maximum.accumulate(np.where(new > 0, first + new - 1, 0))
    return Trie(first, shared, end, depth, (closes - opens + 1) // 2, pointer - 1)


_SPINE = pa.list_(pa.struct([(c, pa.int64()) for c in ("node", "convs", "least", "children", "leaves", "saved", "size")]))
_NUMBERS = ("node", "depth", "conv_id", "parent", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
_SHARD = pa.schema(
    [("kind", pa.string()), ("shard", pa.int64()), *[(c, pa.int64()) for c in _NUMBERS], ("ends_sha256", pa.string()), ("path", pa.binary()), ("spine", _SPINE)]
)
_SHARD_SQL = (
    "kind string, shard long, " + ", ".join(f"{c} long" for c in _NUMBERS) + ", ends_sha256 string, path binary, "
    "spine array<struct<node:long,convs:long,least:long,children:long,leaves:long,saved:long,size:long>>"
)


def _batches(kind: str, shard: int, **columns) -> Iterator[pa.RecordBatch]:
    """Rows of one kind, null in the columns not given."""
    n = len(next(iter(columns.values())))
    given = {"kind": pa.array([kind] * n), "shard": pa.array(np.full(n, shard))}
    given |= {c: v if isinstance(v, pa.Array) else pa.array(v, _SHARD.field(c).type) for c, v in columns.items()}
    whole = pa.record_batch([given.get(f.name, pa.nulls(n, f.type)) for f in _SHARD], schema=_SHARD)
    for low in range(0, n, _ROWS):
        yield whole.slice(low, _ROWS)


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The digests of a column of paths, as two numbers a turn, and the turns of each path."""
    paths = column.to_pylist()
    return np.frombuffer(b"".join(paths), np.uint64).reshape(-1, 2), np.array([len(p) // DIGEST for p in paths], np.int64)


def _ids_digest(ids: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest()


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The trie of one range: inner nodes as results, the two spines, and members that end on them."""
    kept = [(b.column("conv_id").to_numpy(), b.column("path"), b.column("sizes")) for b in batches if b.num_rows]
    if not kept:
        return
    shard = TaskContext.get().partitionId()
    conv = np.concatenate([k[0] for k in kept])
    digests, lengths = (np.concatenate(parts) for parts in zip(*[_flat(k[1]) for k in kept], strict=True))
    sizes = np.concatenate([k[2].flatten().to_numpy() for k in kept]).astype(np.int64)
    t = build(digests, lengths)
    nodes, n = len(t.depth), len(conv)
    offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum(lengths)])

    size = np.zeros(nodes, np.int64)
    new = lengths - t.shared
    row = np.repeat(np.arange(n), new)
    size[1:] = sizes[offsets[row] + t.depth[1:] - 1]
    convs = t.below(np.bincount(t.end, minlength=nodes))
    least = np.full(nodes, _NOBODY)
    np.minimum.at(least, t.end, conv)
    least = t.least(least)
    leaves = t.below((t.size == 1).astype(np.int64))
    saved = t.below((convs - 1) * size)
    children = np.bincount(t.parent[1:], minlength=nodes)

    last, at = [], int(t.end[-1])
    while at >= 0:
        last.append(at)
        at = int(t.parent[at])
    heads = np.arange(lengths[0] + 1)
    tails = np.array(last[::-1])
    spine = np.zeros(nodes, bool)
    spine[heads] = spine[tails] = True

    cuts = np.flatnonzero(np.diff(t.end)) + 1
    digest = np.full(nodes, NO_MEMBERS, object)
    for a, b in zip(np.concatenate([[0], cuts]), np.concatenate([cuts, [n]]), strict=True):
        if not spine[t.end[a]]:
            digest[t.end[a]] = _ids_digest(conv[a:b])
    inner = np.flatnonzero(~spine)
    if inner.size:
        above = t.parent[inner]
        known = ~spine[above]
        yield from _batches(
            "node", shard, node=inner, depth=t.depth[inner], conv_id=least[inner],
            parent=pa.array(above, mask=known), parent_conv_id=pa.array(least[above], mask=~known), n_convs=convs[inner],
            n_children=children[inner], n_leaves=leaves[inner], saved_tokens=saved[inner], ends_sha256=digest[inner],
        )
    on_spine = np.flatnonzero(spine[t.end])
    yield from _batches("end", shard, node=t.end[on_spine], conv_id=conv[on_spine])

    # Of what hangs under a spine node, only that which is off the spines is summed here.
    off = inner[spine[t.parent[inner]]]
    hung = {k: np.zeros(nodes, np.int64) for k in ("children", "leaves", "saved")}
    for name, own in (("children", np.ones(nodes, np.int64)), ("leaves", leaves), ("saved", saved)):
        np.add.at(hung[name], t.parent[off], own[off])

    def told(along: np.ndarray, fresh: np.ndarray) -> list[dict]:
        """The nodes of one spine; those the other spine has told of add nothing."""
        return [
            {
                "node": int(v), "convs": int(convs[v]) * int(f), "least": int(least[v]), "children": int(hung["children"][v]) * int(f),
                "leaves": int(hung["leaves"][v]) * int(f), "saved": int(hung["saved"][v]) * int(f), "size": int(size[v]),
            }
            for v, f in zip(along, fresh, strict=True)
        ]

    both = [(heads, 0, np.ones(len(heads), bool)), (tails, n - 1, ~np.isin(tails, heads))]
    for along, r, fresh in both[: 1 if len(heads) == len(tails) and (heads == tails).all() else 2]:
        path = digests[offsets[r] : offsets[r + 1]].tobytes()
        yield from _batches("spine", shard, path=[path], spine=[told(along, fresh)])


_REFERENCES = pa.list_(pa.struct([("shard", pa.int64()), ("node", pa.int64())]))
_MERGED = pa.schema([*[(c, pa.int64()) for c in ("spine_node", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")], ("places", _REFERENCES)])
_MERGED_SQL = (
    "spine_node long, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "places array<struct<shard:long,node:long>>"
)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The trie of all spines, sorted by path: two rows a shard."""
    rows = [r for b in batches for r in b.to_pylist()]
    if not rows:
        return
    digests = np.frombuffer(b"".join(r["path"] for r in rows), np.uint64).reshape(-1, 2)
    t = build(digests, np.array([len(r["path"]) // DIGEST for r in rows], np.int64))
    nodes = len(t.depth)
    convs, children, leaves, saved, size = (np.zeros(nodes, np.int64) for _ in range(5))
    least = np.full(nodes, _NOBODY)
    places: list[set] = [set() for _ in range(nodes)]
    path: list[int] = [0]
    for k, r in enumerate(rows):
        path[t.shared[k] + 1 :] = range(t.first[k], t.first[k] + len(r["spine"]) - 1 - t.shared[k])
        for v, s in zip(path, r["spine"], strict=True):
            convs[v] += s["convs"]
            children[v] += s["children"]
            leaves[v] += s["leaves"]
            saved[v] += s["saved"]
            size[v] = s["size"]
            least[v] = min(least[v], s["least"])
            places[v].add((r["shard"], s["node"]))
    children += np.bincount(t.parent[1:], minlength=nodes)
    leaves = t.below(leaves + (children == 0))
    saved = t.below(saved + (convs - 1) * size)
    root = np.arange(nodes) == 0
    for low in range(0, nodes, _ROWS):
        part = slice(low, low + _ROWS)
        yield pa.record_batch(
            [
                pa.array(np.arange(nodes)[part]), pa.array(t.depth[part]), pa.array(least[part]),
                pa.array(least[t.parent][part], mask=root[part]), *[pa.array(c[part]) for c in (convs, children, leaves, saved)],
                pa.array([[{"shard": a, "node": b} for a, b in sorted(p)] for p in places[part]], _REFERENCES),
            ],
            schema=_MERGED,
        )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest for each ``spine_node``, of ids that come sorted; only the running digest is held."""
    node, running = None, None
    for batch in batches:
        keys, ids = batch.column("spine_node").to_numpy(), batch.column("conv_id").to_numpy()
        cuts = np.flatnonzero(np.diff(keys)) + 1
        for a, b in zip(np.concatenate([[0], cuts]), np.concatenate([cuts, [len(keys)]]), strict=True):
            if a == b:
                continue
            if keys[a] != node:
                if running is not None:
                    yield pa.record_batch({"spine_node": pa.array([node], pa.int64()), "ends_sha256": [running.hexdigest()]})
                node, running = int(keys[a]), hashlib.sha256()
            else:
                running.update(b",")
            running.update(",".join(map(str, ids[a:b].tolist())).encode())
    if running is not None:
        yield pa.record_batch({"spine_node": pa.array([node], pa.int64()), "ends_sha256": [running.hexdigest()]})


RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations."""
    work = Workspace(conversations.sparkSession, "trie")
    own = work.store(paths(conversations), "own")
    whole = work.store(rebuilt(own), "rebuilt")
    work.drop("own")
    order = ["path", "conv_id"]
    ranges = whole.repartitionByRange(*order).sortWithinPartitions(*order)
    shards = work.store(map_batches(ranges, _shard, _SHARD_SQL), "shards")
    work.drop("rebuilt")

    spines = shards.where("kind = 'spine'").select("shard", "path", "spine").repartition(1).sortWithinPartitions("path", "shard")
    merged = work.store(map_batches(spines, _merge, _MERGED_SQL), "merged")
    places = merged.select("spine_node", F.col("conv_id").alias("spine_conv_id"), F.explode("places").alias("p")).select(
        "spine_node", "spine_conv_id", F.col("p.shard").alias("shard"), F.col("p.node").alias("parent")
    )
    ends = (
        shards.where("kind = 'end'").select("shard", F.col("node").alias("parent"), "conv_id").join(places, ["shard", "parent"])
        .select("spine_node", "conv_id").repartition("spine_node").sortWithinPartitions("spine_node", "conv_id")
    )
    digests = map_batches(ends, _digests, "spine_node long, ends_sha256 string")
    on_spines = merged.join(digests, "spine_node", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_MEMBERS)))
    inner = (
        shards.where("kind = 'node'").join(places, ["shard", "parent"], "left")
        .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "spine_conv_id"))
    )
    return inner.select(*RESULT).unionByName(on_spines.select(*RESULT))
