"""A small corpus with every awkward case, and its labels and benchmark."""

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, fp string, words string, token string, key string"


def sentence(rng, n, start=0):
    return " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(3000)}" for _ in range(n)) + "."


def corpus_rows():
    rng = random.Random(5)
    texts = [None, "", " \t\n ", "One", "Two words"]
    texts += ["\n".join(sentence(rng, 30) for _ in range(4)) for _ in range(40)]
    base = "\n".join(sentence(rng, 40) for _ in range(5))
    texts += [base] * 12  # exact copies
    words = base.split(" ")
    for k in range(12):  # near copies
        changed = list(words)
        changed[7 + 3 * k] = f"changed{k}"
        texts.append(" ".join(changed))
    passage = sentence(rng, 70)
    texts += [sentence(rng, 60) + "\n" + passage + "\n" + sentence(rng, 60) for _ in range(9)]
    common = "This very common line stands in many documents, and says nothing at all."
    texts += [common + "\n" + sentence(rng, 55) for _ in range(15)]
    texts += [("echo " * 90).strip(), "ab" * 3000, "É é     ÀÇ ß İ " * 20, "😀 " * 60]
    texts.append(" ".join(f"w{rng.randrange(5000)}" for _ in range(60_000)))  # a very long one
    texts.append("x" * 200_000)
    texts += [f"password = \"hunter2{k}\" and token: abc\nAKIA" + "Q7" * 9 + " " + "0af9" * 8 + " secret=token:abcdefgh" for k in range(3)]
    texts.append("\x01marks\x02 secret='abcdefg1'\x03 more " + sentence(rng, 50))
    texts += ["Released under the MIT License.\n" + sentence(rng, 50), "(c) 2020 Someone\nreleased UNDER the mit licence", "Copyright 2020 X"]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [rows[20], rows[20], (None, base), (None, None)]  # repeated rows, null ids
    return rows


def benchmark_rows(rows):
    long_text = rows[6][1].replace("\n", " ")
    return [(1, " ".join(long_text.split()[5:20]).upper()), (2, None), (3, ""), (10, "two WORDS"), (11, "nothing of the kind is anywhere in here at all")]


@pytest.fixture(scope="session")
def corpus():
    return corpus_rows()


@pytest.fixture(scope="session")
def docs(spark, corpus):
    full = [(i, t, "en", "s", None if t is None else len(t), "x", "y", "z", "t", "k") for i, t in corpus]
    return spark.createDataFrame(full, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)


@pytest.fixture(scope="session")
def benchmark_items(corpus):
    return benchmark_rows(corpus)


@pytest.fixture(scope="session")
def benchmark(spark, benchmark_items):
    return spark.createDataFrame(benchmark_items, "item_id long, text string")


@pytest.fixture(scope="session")
def by_id(corpus):
    """Distinct documents with an id, in order."""
    return sorted({(i, t) for i, t in corpus if i is not None}, key=lambda r: r[0])
