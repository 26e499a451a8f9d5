"""Personal data and disclosing terms against plain Python, on awkward texts."""

import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from deskrisk.llm import disclosure

PATTERNS = {  # the contract's, as they stand
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def digits(m):
    return re.sub("[^0-9]", "", m)


VALID = {
    "email": lambda m: True,
    "ip": lambda m: all(int(p) <= 255 for p in m.split(".")),
    "card": lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m)),
    "phone": lambda m: 9 <= len(digits(m)) <= 15,
}
VALUE = {"email": str.lower, "ip": str, "card": digits, "phone": digits}
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lowered(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def base_spans(text):
    return [
        (kind, m.start(), m.end(), m[0]) for kind, p in PATTERNS.items() for m in re.finditer(p, text) if VALID[kind](m[0])
    ]


def windows(text):
    """(entity, kind, start, end, words with places) of each valid match."""
    for kind, p in PATTERNS.items():
        places = list(re.finditer(p, text))
        for k, m in enumerate(places):
            if not VALID[kind](m[0]):
                continue
            low = places[k - 1].end() if k else 0
            high = places[k + 1].start() if k + 1 < len(places) else len(text)
            value = VALUE[kind](m[0])
            if k and VALUE[kind](places[k - 1][0]) == value:
                low = min(low + disclosure.CONTEXT, m.start())
            near = []
            for a, b in ((low, m.start()), (m.end(), high)):
                for w in re.finditer(WORD, lowered(text[a:b])):
                    s, e = a + w.start(), a + w.end()
                    reach = m.start() - s if b == m.start() else e - m.end()
                    if e - s >= disclosure.SHORTEST_TERM and reach <= disclosure.CONTEXT:
                        near.append((w[0], s, e))
            yield f"{kind}:{value}", m.start(), m.end(), near


def expected(texts, threshold=disclosure.THRESHOLD, contexts=disclosure.CONTEXTS):
    """Spans of every text, and the remedies of the terms."""
    texts = [t or "" for t in texts]
    c, n, seen, w = Counter(), Counter(), defaultdict(set), Counter()
    for t in texts:
        c.update(re.findall(WORD, lowered(t)))
        for e, _, _, near in windows(t):
            shape = " ".join(x[0] for x in near)
            for term, _, _ in near:
                n[e, term] += 1
                seen[e, term].add(shape)
                w[e] += 1
    total = sum(c.values())
    told = {}
    for (e, t), k in n.items():
        need = threshold * math.log2(total / w[e])
        if len(seen[e, t]) >= contexts and math.log2(k * total / (c[t] * w[e])) >= need:
            near = sum(v for (f, x), v in n.items() if f == e and x[: disclosure.PREFIX] == t[: disclosure.PREFIX])
            of = sum(v for x, v in c.items() if x[: disclosure.PREFIX] == t[: disclosure.PREFIX])
            general = len(t) > disclosure.PREFIX and math.log2(near * total / (of * w[e])) < need
            told[e, t] = t[: disclosure.PREFIX] + "*" if general else "[TERM]"
    out = []
    for t in texts:
        base = base_spans(t)
        terms = {
            (s, e2) for e, _, _, near in windows(t) for term, s, e2 in near
            if (e, term) in told and not any(s < b[2] and b[1] < e2 for b in base)
        }
        out.append([f"{k}:{s}:{e}" for k, s, e, _ in base] + [f"term:{s}:{e}" for s, e in sorted(terms)])
    return out, told


FILLER = "the of and was for with that this from have".split()


def corpus_texts():
    texts = [None, "", "   ", "no data here at all", "x@y", "1.2.3.256 300.1.1.1 0001.2.3.4.5.6 1.2.3.4.5", "a@b.c_d@e.f..g@h.i"]
    texts += ["+1 (555) 123-4567 and +12 34 and +1234567890123456 then ++49 30 1234567", "4111 1111 1111 1111, 4111-1111-1111-1112 41111111111111 11"]
    texts += ["\x01a@b.cc\x02 é😀 mail x.y@z.example.com \x01", "@" * 3000 + "a" * 30000, "1" * 30000 + " 4" * 3000, "1." * 5000]
    for k in range(6):  # a name that only ever stands beside one address, in different windows
        texts.append(f"{FILLER[k]} note {k} from Wilhelmina Odderby wodd@mail.example.com about case{k} {FILLER[-k - 1]} " + "the of and " * 20)
    texts += ["the ode and the oddity were odd; note that odd things happen " * 3] * 4
    texts += ["copy of one window: unheard word beside one@only.example.org and nothing else"] * 9
    texts += ["self@self.example.net near self@self.example.net close self@self.example.net"] * 2
    texts += ["word " * 200 + "far@away.example.com" + " word" * 200 + " +44 20 7946 0958 and 10.0.0.1"]
    return texts


@pytest.fixture(scope="module")
def texts():
    return corpus_texts()


@pytest.fixture(scope="module")
def table(spark, texts):
    rows = [(i, t, "id", "row", 1, "e") for i, t in enumerate(texts)] + [(None, texts[14], "id", "row", 1, "e")]
    return spark.createDataFrame(rows, "doc_id long, text string, id string, row string, term int, entity string").repartition(3)


def test_spans_and_terms_equal_plain_python(table, texts):
    want, told = expected([*texts, texts[14]])
    assert {t for (_, t) in told} >= {"wilhelmina", "odderby"} and not any(t in ("the", "unheard") for _, t in told)
    got = disclosure.summarise(disclosure.find(table)).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        mine = want[r.doc_id if r.doc_id is not None else 14]
        assert (r.spans.split(",") if r.spans else []) == mine, r.doc_id
        for kind in PATTERNS:
            assert r[f"n_{kind}"] == sum(s.startswith(kind + ":") for s in mine)
        assert r.n_terms == sum(s.startswith("term:") for s in mine)


def test_base_digest_leaves_terms_out(table, texts):
    import hashlib

    for r in disclosure.summarise(disclosure.find(table)).where("doc_id is not null").collect():
        base = ",".join(f"{k}:{s}:{e}" for k, s, e, _ in base_spans(texts[r.doc_id] or ""))
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()


def test_threshold_and_contexts_decide(table):
    def terms(**parameters):
        return disclosure.summarise(disclosure.find(table, **parameters)).agg(F.sum("n_terms")).first()[0]

    assert terms(contexts=100) == 0
    assert terms(contexts=1) > terms() > 0
    assert terms(threshold=0.3) >= terms()


def test_sanitised_text_keeps_nothing_protected(table, texts):
    clean = disclosure.sanitise(table)
    assert clean.columns == table.columns
    rows = {r.doc_id: r for r in clean.collect()}
    assert rows[0].text is None and rows[3].text == texts[3] and rows[3].row == "row"
    case = rows[13].text
    assert "[EMAIL]" in case and "odd*" in case.lower() and "odderby" not in case.lower() and "wilhelmina" not in case.lower()
    assert "example.com" not in case
    for r in rows.values():
        assert not base_spans(r.text or ""), r.doc_id


def test_long_texts_empty_table_and_hot_entity(spark, table):
    assert disclosure.summarise(disclosure.find(table.limit(0))).count() == 0
    assert disclosure.sanitise(table.limit(0)).count() == 0
    many = " ".join(f"w{k} hot@hot.example.com" for k in range(3000))
    df = spark.createDataFrame([(i, many) for i in range(3)], "doc_id long, text string")
    rows = disclosure.summarise(disclosure.find(df)).collect()
    assert [r.n_email for r in rows] == [3000] * 3
    want, _ = expected([many] * 3)
    assert rows[0].spans.split(",") == want[0]


def test_disclosing_terms_are_marked_wherever_they_stand(spark):
    rows = [f"{FILLER[k]} from Zebulon zeb@mail.example.com about {FILLER[-k - 1]} " + "the of and " * 50 for k in range(5)]
    rows.append(rows[0] + "😀é " + "word " * 600 + "zebulon, Zebulon" + " word" * 10)  # beyond the windows, and beyond one block
    rows.append("Zebulon stands here without the address")
    rows += ["zebulon", None, "", "xzebulon zebulonx", "x" * 5000 + " \x01ZEBULON\x02", "mail zebulon@other.example.org"]
    _, told = expected(rows, threshold=0.5)
    terms = {t for _, t in told}
    assert "zebulon" in terms and "word" not in terms
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = disclosure.summarise(disclosure.find(df, threshold=0.5)).collect()
    got = {r.doc_id: [s for s in r.spans.split(",") if s.startswith("term")] for r in found}
    for i, text in enumerate(rows):
        base = base_spans(text or "")
        words = [m for m in re.finditer(WORD, lowered(text or "")) if m[0] in terms]
        whole = [m for m in words if not any(m.start() < b[2] and b[1] < m.end() for b in base)]
        assert got[i] == [f"term:{m.start()}:{m.end()}" for m in whole], i
    assert got[6][0] == "term:0:7" and got[7] == ["term:0:7"] and not got[10] and got[11] and not got[12]
    clean = {r.doc_id: r.text for r in disclosure.sanitise(df, threshold=0.5).collect()}
    assert not [i for i, t in clean.items() if re.search(r"\bzebulon\b", (t or "").lower())]
