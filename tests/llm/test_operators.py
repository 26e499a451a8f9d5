"""Each operator against brute force on the small corpus, and on an empty table."""

import hashlib
import itertools
import math
import pathlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from deskrisk.llm import bytebpe, compact_windows, contamination, hmm, licences, line_dedup, simhash, suffixes
from deskrisk.llm.components import components
from deskrisk.llm.secret_scan import ADDED, BASE, Ledger, Rule, summarise
from deskrisk.llm.settings import vocabulary
from deskrisk.llm.workspace import Workspace


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def found(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())


def smallest(ids, links):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def test_simhash_equals_brute_force(docs, empty, by_id, monkeypatch):
    prints = {}
    for i, t in by_id:
        w = words(t)
        h = [xxhash.xxh64_intdigest(b" ".join(w[k : k + 3]), 42) for k in range(max(1, len(w) - 2))] if w else []
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0
    ids = sorted(prints)
    links = [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    roots = smallest(ids, links)
    for crowded in (simhash.CROWDED, 1):  # 1: every bucket goes by shared neighbours
        monkeypatch.setattr(simhash, "CROWDED", crowded)
        out = simhash.near_duplicates(docs)
        got = [r for r in out.collect() if r.doc_id is not None]
        assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(i, f"{prints[i]:016x}", roots[i]) for i in ids}
        assert out.count() == docs.count()
    assert simhash.near_duplicates(empty).count() == 0


def test_thresholds_add_up(spark):
    rng = np.random.default_rng(1)
    prints = spark.createDataFrame([(int(x),) for x in rng.integers(-(2**62), 2**62, 300)], "fp long")
    groups = simhash.correlated_groups(prints)
    assert sorted(b for g in groups for b in g) == list(range(64))
    chosen = simhash.Allocation(prints, groups).thresholds(np.array([0, -1, 12345], np.int64))
    assert (chosen.sum(1) == simhash.DISTANCE - simhash.GROUPS + 1).all() and (chosen >= -1).all()


def test_components_of_chains_stars_and_pairs(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (500, 400), (400, 300)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.root for r in components(df, Workspace(spark, "test")).collect()}
    want = smallest({x for e in links for x in e}, links)
    assert got == {k: v for k, v in want.items()}
    assert components(df.limit(0), Workspace(spark, "test")).count() == 0


def test_line_dedup_equals_brute_force(docs, empty, by_id):
    first, lines = {}, []
    for i, t in by_id:
        for k, line in enumerate((t or "").split("\n")):
            w = frozenset(x for x in line.split(" ") if x)
            if w:
                lines.append((i, k, w))
                first.setdefault(w, (i, k))
    sets = list(first)
    earlier = defaultdict(list)
    for a, w in enumerate(sets):
        for v in sets[:a]:
            if 10 * len(w & v) >= 8 * len(w | v):
                earlier[w].append(first[v])
    goes = defaultdict(list)
    for i, k, w in lines:
        if min([first[w], *earlier[w]]) < (i, k):
            goes[i].append(k)
    got = found(line_dedup.near_duplicate_lines(docs))
    assert {i: got[i].removed for i, _ in by_id} == {i: ",".join(map(str, goes[i])) for i, _ in by_id}
    assert sum(r.n_links for r in got.values()) == 2 * sum(map(len, earlier.values()))
    shorter = line_dedup.remove_lines(docs)
    assert shorter.columns == docs.columns and shorter.count() == docs.count()
    texts = {r.doc_id: r.text for r in shorter.where("doc_id is not null").collect()}
    for i, t in by_id:
        want = None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in goes[i])
        assert texts[i] == want
    assert line_dedup.near_duplicate_lines(empty).count() == 0 and line_dedup.remove_lines(empty).count() == 0


def test_lines_of_an_id_with_several_texts_stay_apart(spark):
    rows = [(1, "a", "g", "i"), (2, "b\na", "g", "i"), (2, "c\nd", "g", "i"), (2, "c\nd", "g", "i"), (3, "d", "g", "i"), (None, "a", "g", "i")]
    df = spark.createDataFrame(rows, "doc_id long, text string, __gone string, __id string")
    shorter = line_dedup.remove_lines(df)
    assert shorter.columns == df.columns
    texts = sorted((r.doc_id or 0, r.text) for r in shorter.collect())
    assert texts == [(0, "a"), (1, "a"), (2, "b"), (2, "c\nd"), (2, "c\nd"), (3, "")]


def test_the_set_of_a_line_is_built_once(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "_rarity", lambda texts: F.array(F.lit(0).cast("tinyint")))
    rows = [(1, "a b\n\n  \n\tb"), (2, " "), (3, "")]
    lines = line_dedup._lines(line_dedup._texts(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text"))
    assert sorted((r.id, r.at, r.n) for r in lines.collect()) == [(1, 0, 2), (1, 3, 1)]  # a tab is no blank
    assert lines._jdf.queryExecution().optimizedPlan().toString().count("array_distinct(") == 1


def test_line_classes_and_links_reach_all_documents(spark):
    a, b = [f"a{k}" for k in range(10)], [f"b{k}" for k in range(10)]
    near = lambda w, k: " ".join([*w[:9], f"other{k}"])
    texts = {
        1: " ".join(a), 2: near(a, 1) + "\n" + " ".join(b), 3: near(b, 1),  # 3 reaches 1 by way of 2
        4: near(b, 1) + "\n" + near(b, 1), 5: near(b, 1) + "\n" + "c d e",  # later copies of a linked set
        6: "c d e", 7: "alone", 8: None,
    }
    sets = {i: {frozenset(x.split(" ")) for x in (t or "").split("\n") if x} for i, t in texts.items()}
    match = lambda w, v: 10 * len(w & v) >= 8 * len(w | v)
    every = set().union(*sets.values())
    links = [(i, j) for i in sets for j in sets if j < i and any(match(w, v) for w in sets[i] for v in sets[j])]
    got = found(line_dedup.near_duplicate_lines(spark.createDataFrame(list(texts.items()), "doc_id long, text string")))
    classes = {i: i for i in texts}
    for _ in texts:
        for i, j in links:
            classes[i] = classes[j] = min(classes[i], classes[j])
    assert {i: got[i].class_id for i in texts} == classes
    assert {i: got[i].n_set_links for i in texts} == {i: sum(match(w, v) for w in sets[i] for v in every - {w}) for i in texts}


def test_suffixes_equal_brute_force(docs, empty, by_id):
    got, seen = found(suffixes.remove_repeats(docs)), {}
    for i, t in by_id:
        data = (t or "").encode()
        covered = bytearray(len(data))
        for k in range(len(data) - 49):
            if seen.setdefault(data[k : k + 50], i) < i:
                covered[k : k + 50] = b"\x01" * 50
        kept = bytes(b for b, c in zip(data, covered, strict=True) if not c)
        runs = sum(c and (k == 0 or not covered[k - 1]) for k, c in enumerate(covered))
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) == (len(data), sum(covered), runs, sha(kept), kept)
    assert suffixes.remove_repeats(empty).count() == 0


def test_suffix_passes_go_by_slices_that_hold_every_window_once(spark, docs, monkeypatch):
    # On disk at a time: the rows of one slice, which were all windows at once.
    passes, shared = [], suffixes._shared
    monkeypatch.setattr(suffixes, "_shared", lambda rows, key: passes.append((key, rows.count())) or shared(rows, key))
    work, every = Workspace(spark, "test"), []
    for slices in (suffixes.SLICES, 1, suffixes.SPAN + 1):
        monkeypatch.setattr(suffixes, "SLICES", slices)
        passes.clear()
        ranges = suffixes.repeated_ranges(docs, work, "doc_id", "text")
        sizes = [n for key, n in passes if key == ["h", "g"]]
        every.append((sum(sizes), {tuple(r) for r in ranges.collect()}))
        assert len(sizes) == slices and max(sizes) <= max(0.8, 1 / slices) * sum(sizes)
        work = Workspace(spark, "test")
    assert every[0][0] and every[0] == every[1] == every[2]


def test_hmm_base_figures_and_exact_likelihood(docs, empty, corpus, monkeypatch):
    monkeypatch.setattr(hmm, "HEAD", 300)
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    counts = Counter(w for i, t in corpus if not held(i) for w in hmm.tokens(t))
    total, distinct = sum(counts.values()), len(counts)
    out = hmm.score(docs).collect()
    assert len(out) == len(corpus)
    got = {r.doc_id: r for r in out}
    for i, t in corpus:
        if i is None:
            continue
        own, r = hmm.tokens(t), got[i]
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in own)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(i), len(own), sum(counts[w] > 0 for w in own), total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score < 0
    # The scaled recursion against a plain sum over all paths.
    rng = np.random.default_rng(3)
    mass = rng.random(5)
    model = hmm.Model.begin(mass / mass.sum())
    sequences = [np.array([0, 3, 1]), np.array([2]), np.array([4, 4, 0, 1])]
    for s, log in zip(sequences, model.forward(hmm.Layout(sequences)), strict=True):
        alpha = model.start * model.emit[s[0]]
        for x in s[1:]:
            alpha = (alpha @ model.move) * model.emit[x]
        assert log == pytest.approx(math.log(alpha.sum()))
    _, _, share = model.expect(hmm.Layout(sequences))
    assert np.allclose(share.sum(1), 1)
    assert hmm.score(empty).count() == 0


def test_baum_welch_counts_equal_a_sum_over_all_paths():
    rng = np.random.default_rng(4)
    mass = rng.random(5)
    model = hmm.Model.begin(mass / mass.sum())
    model.move = rng.random((hmm.STATES, hmm.STATES))
    model.move /= model.move.sum(1, keepdims=True)
    sequences = [np.array([0, 3, 1]), np.array([2]), np.array([4, 0]), np.array([1, 1, 4])]
    starts, moves, shares = np.zeros(hmm.STATES), np.zeros((hmm.STATES, hmm.STATES)), np.zeros((5, hmm.STATES))
    for s in sequences:
        weights = {}
        for path in itertools.product(range(hmm.STATES), repeat=len(s)):
            p = model.start[path[0]] * model.emit[s[0], path[0]]
            for t in range(1, len(s)):
                p *= model.move[path[t - 1], path[t]] * model.emit[s[t], path[t]]
            weights[path] = p
        total = sum(weights.values())
        for path, p in weights.items():
            starts[path[0]] += p / total
            for t, x in enumerate(s):
                shares[x, path[t]] += p / total
                if t:
                    moves[path[t - 1], path[t]] += p / total
    layout = hmm.Layout(sequences)
    got_starts, got_moves, got_shares = model.expect(layout)
    summed = np.zeros((5, hmm.STATES))
    np.add.at(summed, layout.flat, got_shares)
    assert np.allclose(got_starts, starts) and np.allclose(got_moves, moves) and np.allclose(summed, shares)


def test_held_out_texts_score_above_the_word_counts(spark):
    out = hmm.score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("held_out")
    score, base = out.agg(F.sum("score"), F.sum("base_score")).first()
    assert score > base


def test_compact_windows_are_the_wide_nodes_of_the_cartesian_tree():
    rng = np.random.default_rng(2)
    hashes = rng.integers(0, 2**63, 400).astype(np.uint64)
    _, left, centre, right = compact_windows.compact_windows(hashes, 0)
    values = (hashes ^ compact_windows._SEEDS[0]) * compact_windows._B
    values ^= values >> np.uint64(32)
    want = []
    for c in range(400):
        a = b = c
        while a and values[a - 1] > values[c]:
            a -= 1
        while b < 399 and values[b + 1] > values[c]:
            b += 1
        if b - a + 1 >= compact_windows.PASSAGE:
            want.append((a, c, b))
    assert list(zip(left.tolist(), centre.tolist(), right.tolist(), strict=True)) == want


def test_every_exactly_repeated_passage_is_found(docs, empty, by_id):
    got, seen = found(compact_windows.near_duplicate_passages(docs)), {}
    links = []
    for i, t in by_id:
        own = words(t)
        covered = set()
        for k in range(len(own) - 49):
            first = seen.setdefault(tuple(own[k : k + 50]), i)
            if first < i:
                covered |= set(range(k, k + 50))
                links.append((first, i))
        spans = [tuple(map(int, s.split(":"))) for s in got[i].ranges.split(",") if s]
        assert covered <= {x for a, b in spans for x in range(a, b)}
    for a, b in links:
        assert got[a].component_id == got[b].component_id
    clean = [i for i, t in by_id if 6 <= i < 20]
    assert all(got[i].n_links == 0 and got[i].component_id == i for i in clean)
    assert compact_windows.near_duplicate_passages(empty).count() == 0


@pytest.mark.parametrize("at_once", [contamination.AT_ONCE, 3])
def test_decontamination_equals_brute_force(docs, empty, by_id, benchmark, benchmark_items, at_once, monkeypatch):
    """With the set of hashes in one slice, and in many."""
    monkeypatch.setattr(contamination, "AT_ONCE", at_once)
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(upper))
    windows = defaultdict(set)
    for item, t in benchmark_items:
        w = split(t)
        n = min(10, len(w))
        for a in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[a : a + n])].add(item)
    got = found(contamination.find_leaks(docs, benchmark))
    bad = set()
    for i, t in by_id:
        w, hit, items = split(t), set(), set()
        for n in {len(k) for k in windows}:
            for a in range(len(w) - n + 1):
                if own := windows.get(tuple(w[a : a + n])):
                    hit |= set(range(a, a + n))
                    items |= own
        r = got[i]
        digest = sha(",".join(sorted(map(str, items))))
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (len(w), len(hit), len(items), digest, bool(hit))
        bad |= {i} if hit else set()
    assert bad
    clean = contamination.remove_contaminated(docs, benchmark)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {i for i in got if i not in bad}
    assert contamination.find_leaks(empty, benchmark).count() == 0
    assert not found(contamination.find_leaks(docs, benchmark.limit(0)))[6].contaminated


def test_a_large_benchmark_finds_the_same(spark, docs, benchmark):
    """A million more windows, none of which occurs, change no row; no join gets unfiltered places."""
    words = [F.concat(F.lit("q"), F.xxhash64("id", F.lit(k)).bitwiseAND(F.lit((1 << 40) - 1)).cast("string")) for k in range(40)]
    many = spark.range(33_000).select((F.col("id") + 1000).alias("item_id"), F.concat_ws(" ", *words).alias("text"))
    few = {tuple(map(str, r)) for r in contamination.find_leaks(docs, benchmark).collect()}
    out = contamination.find_leaks(docs, benchmark.unionByName(many))
    assert {tuple(map(str, r)) for r in out.collect()} == few
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("BroadcastHashJoin") < len(plan)


def test_items_without_an_id_contaminate(spark):
    docs = spark.createDataFrame([(1, "two of words here"), (2, "nothing")], "doc_id long, text string")
    items = spark.createDataFrame([(None, "of words")], "item_id long, text string")
    got = found(contamination.find_leaks(docs, items))
    assert [(got[i].n_hit, got[i].n_items, got[i].contaminated) for i in (1, 2)] == [(2, 0, True), (0, 0, False)]
    assert [r.doc_id for r in contamination.remove_contaminated(docs, items).collect()] == [2]


def test_bpe_equals_the_public_library(docs, empty, corpus):
    tiktoken = pytest.importorskip("tiktoken")
    import base64

    path, pattern = vocabulary()
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    got = found(bytebpe.round_trip(docs, path, pattern))
    for i, t in corpus:
        if i is not None:
            ids = library.encode_ordinary(t or "")
            assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (len(ids), sha(" ".join(map(str, ids))), sha(t or ""))
    small = docs.where(F.length("text") < 5000)
    back = found(bytebpe.decode(bytebpe.encode(small, path, pattern), path, pattern))
    assert {i: r.text for i, r in back.items()} == {r.doc_id: r.text for r in small.collect()}
    assert bytebpe.round_trip(empty, path, pattern).count() == 0


def test_licences(spark, docs, empty):
    got = found(licences.scan(docs).where("licences <> ''"))
    assert sorted((r.licences, r.whole_text, r.n_notices) for r in got.values()) == [("MIT", "", 1), ("MIT", "MIT", 1)]
    full = spark.createDataFrame([(1, "copyright (c) 2020 A. Author\n" + licences.KNOWN[9][1].upper().replace(",", " ;"))], "doc_id long, text string")
    assert licences.scan(full).first().whole_text == "MIT"
    assert licences.scan(docs).count() == docs.select("doc_id", "text").distinct().count()
    assert licences.scan(empty).count() == 0


def test_whole_licence_texts_are_known(spark):
    folder = pathlib.Path(licences.__file__).parent / "licence_texts"
    rows = [(p.stem, p.read_text(encoding="utf-8", errors="replace")) for p in sorted(folder.glob("*.txt"))]
    assert len(rows) == 14
    apache = dict(rows)["Apache-2.0"]
    rows.append(("Apache-2.0", apache.replace("Copyright [yyyy] [name of copyright owner]", "Copyright 2020 A. Author")))
    rows.append(("Apache-2.0", apache[: apache.index("APPENDIX")]))
    mit = licences.KNOWN[9][1].removeprefix("MIT License")
    rows += [("MIT", "The MIT License (MIT)\n\nCopyright (c) 2020 A. Author" + mit), ("MIT", "Copyright (c) 2020 A. Author" + mit)]
    bsd = dict(rows)["BSD-3-Clause"].replace("the University", "the copyright holder").replace("REGENTS AND", "COPYRIGHT HOLDERS AND")
    rows.append(("BSD-3-Clause", "BSD 3-Clause License\n\n" + bsd.replace("REGENTS OR", "COPYRIGHT HOLDER OR")))
    rows.append(("", apache + "and a word"))
    got = found(licences.scan(spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")))
    assert [got[i].whole_text for i in range(len(rows))] == [name for name, _ in rows]


PLAIN = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
    "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
}


def test_secret_spans_equal_plain_matching(spark, docs, empty, corpus, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    ledger.scan(docs)
    out = summarise(ledger.findings(docs))
    assert out.count() == len(corpus)
    got = found(out)
    for i, t in corpus:
        if i is None:
            continue
        spans = [
            (m.start(), k, m.end(), kind) for k, (kind, (p, good)) in enumerate(PLAIN.items()) for m in re.finditer(p, t or "") if good(m)
        ]
        spans.sort()
        r = got[i]
        assert r.base_sha256 == sha(",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans))
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[3] == kind for s in spans) for kind in PLAIN]
    ledger = Ledger(spark, str(tmp_path / "none"))
    ledger.scan(empty)
    assert ledger.findings(empty).count() == 0


def test_the_ledger_scans_only_what_it_has_not_seen(spark, docs, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    first = docs.where("doc_id < 40")
    ledger.scan(first, BASE)
    n = ledger.read().count()
    assert n == first.select("text").distinct().count() - 1  # null and empty are one content
    ledger.scan(first, BASE)
    assert ledger.read().count() == n
    ledger.scan(docs, BASE)  # new contents
    m = ledger.read().count()
    assert m == docs.select(F.coalesce("text", F.lit(""))).distinct().count()
    newer = Rule("assign", BASE[0].pattern, 7, version=2)
    ledger.scan(docs, (newer, *BASE[1:], *ADDED))  # new rules alone
    latest = ledger.read().select(F.explode("results.rule").alias("rule"), "blob")
    assert latest.groupBy("rule", "blob").count().where("count > 1").count() == 0
    assert latest.where("rule = 'assign:2'").count() == latest.where("rule = 'hex:1'").count() == m


def test_pieces_are_held_once_and_merges_in_arrays():
    from deskrisk.llm.settings import vocabulary

    path, pattern = vocabulary()
    with open(path, "rb") as file:
        codec = bytebpe.Codec(file.read(), pattern)
    partners, ranks = codec.right_of.of(codec.rank[b"t"])
    want = sorted((codec.rank[t[1:]], r) for t, r in codec.rank.items() if len(t) > 1 and t[:1] == b"t" and t[1:] in codec.rank)
    assert list(zip(partners.tolist(), ranks.tolist(), strict=True)) == want
    seen, learn = [], codec.learn
    codec.learn = lambda pieces: (seen.append(list(pieces)), learn(seen[-1]))
    texts = ["one wordx one wordx"] * 50 + ["one"]
    ids = list(codec.encode_together(texts))
    assert len(seen) == 1 and len(seen[0]) == len(set(seen[0])) < 6
    assert codec.decode(ids[7].tolist()) == texts[7].encode() and [i.tolist() for i in ids] == [codec.encode(t) for t in texts]
