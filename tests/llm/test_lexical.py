"""Reversed lexical search against a plain ranking in Python."""

import math
import re
import random
from collections import Counter

import numpy as np
import pytest

from tallyline.llm import lexical
from tallyline.llm.lexical import Heaps, rank_documents, term_counts

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(FOLD))


def brute(docs, items, best=10):
    counted = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in set(items):
        scores = []
        asked = Counter(terms(text))
        for doc, c in counted:
            m = 100 - 75 + (75 * sum(c.values()) * n) // total
            s = sum(k * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m)) for t, k in asked.items() if c[t])
            if s > 0:
                scores.append((-s, doc is None, doc or 0))
        out += [(item, k + 1, None if none else d, -s) for k, (s, none, d) in enumerate(sorted(scores)[:best])]
    return sorted(out, key=str)


def ranked(spark, docs, items, **options):
    d = spark.createDataFrame([(t, i, 1, "x") for i, t in docs], "text string, doc_id long, rank int, item_id string")
    b = spark.createDataFrame([(t, i, 2.0) for i, t in items], "text string, item_id long, score double")
    df = rank_documents(d, b, **options)
    assert df.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    return sorted((tuple(r) for r in df.collect()), key=str)


def corpus(n, seed, words=60, length=30):
    rng = random.Random(seed)
    vocabulary = [f"W{k}é" if k % 3 else f"w{k}" for k in range(words)]
    return [(k, " ".join(rng.choices(vocabulary, weights=[1 / (j + 1) for j in range(words)], k=rng.randint(0, length)))) for k in range(n)]


def test_ranking_with_ties(spark):
    docs, items = corpus(400, 1), corpus(30, 2)
    docs += [(1000 - k, "w3 w6 w9") for k in range(60)]  # copies, by falling ids
    assert ranked(spark, docs, items) == brute(docs, items)


def test_edges(spark):
    docs = [(1, None), (2, ""), (3, " .,;"), (4, "A-b_C"), (4, "a b c"), (4, "a b c"), (None, "a b c"), (None, "zz"), (5, "Ä ä a" * 40), (-6, "a b c"),
            (7, "😀".encode("utf-16", "surrogatepass").decode("utf-16") + " 12 a"), (8, "x" * 300_000 + " b " + "y " * 200_000)]
    items = [(1, "a"), (1, "a"), (1, "c C"), (2, None), (3, ""), (4, "..."), (None, "b zz"), (5, "unknown"), (6, "\U0001f600 12 y " + "a " * 3000)]
    assert ranked(spark, docs, items) == brute(docs, items)
    assert ranked(spark, [], items) == [] == ranked(spark, docs, [])
    assert ranked(spark, [(1, None)], items) == [] == ranked(spark, docs, [(1, "?")])


def test_blocks_pieces_and_whole_numbers(spark, monkeypatch):
    """Small blocks, pieces of texts and cells, and sums beyond the whole numbers of doubles."""
    docs, items = corpus(300, 3, length=200), corpus(12, 4) + [(99, "w0 w3 " * 1_500_000)]
    want = brute(docs, items, 3)
    monkeypatch.setattr(lexical, "PIECE", 50)
    monkeypatch.setattr(lexical, "CELLS", 100)
    assert ranked(spark, docs, items, best=3, block_bytes=1000) == want


def test_terms_of_pieces(monkeypatch):
    text = " ".join(f"Wört{k % 7}" for k in range(1000))
    whole = term_counts(text.encode())
    monkeypatch.setattr(lexical, "PIECE", 13)
    assert term_counts(text.encode()) == whole == (1000, Counter(t.encode() for t in terms(text)))


@pytest.mark.parametrize("seed", range(5))
def test_heaps_keep_the_best(seed):
    rng = np.random.default_rng(seed)
    heaps, rows = Heaps(3, 4), []
    for _ in range(20):
        scores, place = rng.integers(0, 6, (rng.integers(1, 30), 3)), rng.integers(-50, 50, 40)
        heaps.add(scores, place[:len(scores)], np.zeros(len(scores), bool))
        rows += [(s, -int(p)) for s, p in zip(scores.tolist(), place)]
    for i, heap in enumerate(heaps.heaps):
        assert sorted(h[:2] for h in heap) == sorted((s[i], p) for s, p in rows if s[i] > 0)[-4:]
