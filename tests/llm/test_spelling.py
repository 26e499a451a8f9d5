"""Spelling variants against plain Python."""

import random
import re
import zlib
from collections import Counter

import pytest

from deskrisk.llm import spelling


def plain_words(docs):
    counts = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def one_edit(u, v):
    if len(u) > len(v):
        u, v = v, u
    if len(v) - len(u) > 1 or u == v:
        return False
    k = 0
    while k < len(u) and u[k] == v[k]:
        k += 1
    return u[k + 1 :] == v[k + 1 :] if len(u) == len(v) else u[k:] == v[k + 1 :]


def expected(docs):
    words = plain_words(docs)
    near = {w: [v for v in words if abs(len(w) - len(v)) < 2 and one_edit(w, v)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), words[form[w]] if form[w] else None)
    return out


def awkward_docs():
    rng = random.Random(3)
    seeds = ["".join(rng.choice("abcdeéß") for _ in range(rng.randrange(6, 13))) for _ in range(60)]
    seeds += ["aaaaaa", "aaaaaaa", "aaaaaaaa", "aaabaaa", "Écolières", "l" * 63, "l" * 64, "l" * 65, "l" * 66, "l" * 30 + "m" + "l" * 34]
    seeds += ["verylongword" * 9, "verylongword" * 8 + "verylongwort", "verylongword" * 8 + "verylongwordx", "ßberylongword" + "verylongword" * 8]
    seeds += ["z" * 40_000, "z" * 20_000 + "y" + "z" * 20_000]
    pool = []
    for s in seeds:
        pool += [s] * (5 if len(s) > 1000 else rng.choice([5, 30, 160]))
        for _ in range(3 if len(s) < 100 else 0):
            k = rng.randrange(len(s))
            variant = rng.choice([s[:k] + s[k + 1 :], s[:k] + rng.choice("abcé") + s[k:], s[:k] + rng.choice("abcé") + s[k + 1 :]])
            pool += [variant] * rng.choice([4, 5, 6, 26])
    pool += ["chainforme"] * 200 + ["chainformi"] * 32 + ["chainfoxmi"] * 6  # a form of a form
    rng.shuffle(pool)
    texts = [" ".join(pool[k : k + 40]) for k in range(0, len(pool), 40)]
    docs = list(enumerate(texts))
    return [*docs, docs[1], docs[1], (None, texts[2]), (None, None), (900, None), (901, ""), (902, "÷×ÀÞ short, UPPER-case ümlaut’s 123 " * 7)]


@pytest.fixture(scope="module")
def cases():
    return awkward_docs()


def test_variants_equal_plain_python(spark, cases):
    df = spark.createDataFrame([(*r, "w", "p") for r in cases], "doc_id long, text string, word string, path string").repartition(3)
    want = expected(cases)
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(df).collect()}
    assert got.keys() == want.keys()
    wrong = {w: (got[w], want[w]) for w in want if got[w] != want[w]}
    assert not wrong
    assert sum(r[0] is not None for r in want.values()) > 20
    assert any(r[1] not in (w, r[0]) for w, r in want.items())  # a chain of forms
    assert any(len(w) > spelling.DEEPEST and r[3] for w, r in want.items())


def test_long_and_short_paths_meet(spark, cases, monkeypatch):
    """The same pairs whatever the depth at which the walk gives way to the hashes."""
    monkeypatch.setattr(spelling, "DEEPEST", 9)
    df = spark.createDataFrame(cases, "doc_id long, text string")
    want = expected(cases)
    assert {r.word: r.n_near for r in spelling.variants(df).collect()} == {w: r[3] for w, r in want.items()}


def test_empty_table_and_no_neighbours(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(none).count() == 0
    lone = spark.createDataFrame([(1, "lonely " * 9)], "doc_id long, text string")
    assert [tuple(r) for r in spelling.variants(lone).collect()] == [("lonely", None, "lonely", 9, 0, None)]
