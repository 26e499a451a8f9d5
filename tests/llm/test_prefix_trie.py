"""The conversation trie against plain Python, in one shard and in many."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from deskrisk.llm import prefix_trie


def expected(rows):
    """{(depth, smallest member): the other columns} from (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
            own[c].append(((turn is not None, turn or 0), role, digest, text))
    own = {c: [(t[1], t[3]) for t in sorted(ts)] for c, ts in own.items()}
    paths = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        paths[c] = tuple(own.get(c - c % 5, [])[:h] + ts[h:])
    members, kids = defaultdict(list), defaultdict(set)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
            if d:
                kids[p[: d - 1]].add(p[:d])
    out = {}

    def visit(node):  # (leaves, saved)
        below = [visit(k) for k in kids[node]]
        size = len(node[-1][1].encode()) if node else 0
        leaves = sum(b[0] for b in below) or 1
        saved = (len(members[node]) - 1) * size + sum(b[1] for b in below)
        ends = ",".join(map(str, sorted(c for c in members[node] if len(paths[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        out[len(node), min(members[node])] = (
            parent, len(members[node]), len(kids[node]), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()
        )
        return leaves, saved

    if paths:
        visit(())
    return out


def got(df):
    rows = df.collect()
    found = {
        (r.depth, r.conv_id): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in rows
    }
    assert len(found) == len(rows)
    return found


def sample_rows():
    rng = random.Random(11)
    says = ["hello", "hé 😀", "", "a much longer turn of text, said again and again " * 3, "ok"]
    rows = []
    for c in range(120):
        for t in range(rng.randrange(1, 13)):
            rows.append((c, t, "user" if t % 2 == 0 else "bot", rng.choice(says[:2]) if t < 3 else rng.choice(says)))
    for c in range(200, 420):  # a hot conversation, many times over
        rows += [(c, t, "user", f"same {t}") for t in range(10)]
    rows += [(c, t, "user", f"same {t}") for c in (505, 512, 514) for t in range(300 if c == 505 else 9)]
    rows += [(601, 0, "user", "lone"), (603, 0, None, None), (604, None, "user", "first"), (604, 0, "user", "second"), (604, 0, "user", "second")]
    rows += [(606, 1, "b", "tie"), (606, 1, "a", "tie"), (606, 1, "a", "other"), (None, 0, "user", "nobody's"), (10**12 + 5, 0, "user", "big")]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def rows():
    return sample_rows()


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_trie_equals_plain_python(spark, rows, shards, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 8)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", shards)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        df = spark.createDataFrame([(*r, "p", 1) for r in rows], "conv_id long, turn int, role string, text string, path string, shard int")
        assert got(prefix_trie.prefix_trie(df)) == expected(rows)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_small_tables(spark):
    schema = "conv_id long, turn int, role string, text string"
    assert prefix_trie.prefix_trie(spark.createDataFrame([], schema)).count() == 0
    assert prefix_trie.prefix_trie(spark.createDataFrame([(None, 1, "a", "b")], schema)).count() == 0
    for rows in ([(3, 0, "a", "b")], [(0, 0, "a", "b")], [(5, 0, None, "x"), (6, 0, "", "x")]):
        assert got(prefix_trie.prefix_trie(spark.createDataFrame(rows, schema))) == expected(rows)


def test_closing_parentheses_over_blocks(monkeypatch):
    rng = random.Random(1)
    for block in (4, 16, 256):
        monkeypatch.setattr(prefix_trie, "BLOCK", block)
        for n in (1, 2, 50, 3000):
            word, depth, left = [], 0, n
            while left or depth:
                up = left and (depth == 0 or rng.random() < 0.55)
                word.append(bool(up))
                depth += 1 if up else -1
                left -= bool(up)
            stack, want = [], {}
            for k, up in enumerate(word):
                if up:
                    stack.append(k)
                else:
                    want[stack.pop()] = k
            opening = np.array(word)
            opens = np.flatnonzero(opening)
            assert dict(zip(opens.tolist(), prefix_trie.Excess(opening).close(opens).tolist(), strict=True)) == want
