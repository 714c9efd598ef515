"""Suffix-array matches against brute force."""

import hashlib
import random
import re
import time

import numpy as np
import pytest

from tallyline.llm.decontam import Items, find_matches, occurrences, remove_contaminated, suffix_array, summary

_AZ = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return _WORD.findall((text or "").translate(_AZ))


def brute(docs, items, window=10):
    out = []
    for doc_id, text in docs:
        w, hit, ids = words(text), set(), set()
        for item_id, item in items:
            v = words(item)
            n = min(window, len(v))
            grams = {tuple(v[i:i + n]) for i in range(len(v) - n + 1)} if n else set()
            for i in range(len(w) - n + 1) if n else ():
                if tuple(w[i:i + n]) in grams:
                    hit.update(range(i, i + n))
                    ids.add(item_id)
        named = ",".join(sorted(str(i) for i in ids if i is not None))
        out.append((str(doc_id), len(w), len(hit), len([i for i in ids if i is not None]),
                    hashlib.sha256(named.encode()).hexdigest(), bool(hit)))
    return sorted(out)


def rows_of(df):
    return sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect())


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(3)
    for n in (1, 2, 50, 400):
        text = rng.integers(0, 3, n)
        order = suffix_array(text, n)
        assert order.tolist() == sorted(range(n), key=lambda i: text[i:].tolist())
        short = suffix_array(text, 4)
        assert [text[i:i + 4].tolist() for i in short] == sorted(text[i:i + 4].tolist() for i in range(n))


def test_occurrences_match_a_scan():
    rng = np.random.default_rng(5)
    items = Items([(str(k), " ".join(f"w{x}" for x in rng.integers(0, 3, size))) for k, size in enumerate((2, 5, 14, 30, 1))], 4)
    text = rng.integers(0, len(items.number) + 1, 600)
    suffix, at, like = occurrences(text, items)
    assert len(set(zip(items.item[suffix].tolist(), at.tolist()))) == len(at)
    got = {(s, p) for first, p in zip(suffix.tolist(), at.tolist()) for s in np.flatnonzero(like == first).tolist()}
    want = set()
    for s, (item, place) in enumerate(zip(items.item.tolist(), items.place.tolist())):
        n = int(items.depth[item])
        want |= {(s, i) for i in range(len(text) - n + 1) if (text[i:i + n] == items.words[place:place + n]).all()}
    assert got == want


ITEMS = [(1, "one two three four five six seven eight nine ten eleven twelve"), (2, "Short ITEM here"), (3, ""), (4, None), (5, "...!"),
         (6, "one two three four five six seven eight nine ten eleven twelve"), (None, "nameless words of an item"),
         (10, "a b a b a b a b a b a b a b a b"), (11, "é ü 日本 x1")]
TEXTS = [(1, "Zero ONE, two; three-four five six seven eight nine ten. Eleven?"), (2, "one two three four five six seven eight nine"),
         (3, None), (4, ""), (5, "a short item, here and a short-item here"), (5, "a short item, here and a short-item here"),
         (None, "nameless words of an item"), (7, "a b " * 40), (8, "é ü 日本 x1 É Ü"), (9, "x " * 3000 + ITEMS[0][1]), (12, "short item")]


@pytest.mark.parametrize("block_bytes", [1 << 24, 60])
def test_edge_rows(documents, spark, block_bytes):
    items = spark.createDataFrame([(i, t, "m") for i, t in ITEMS], "item_id long, text string, matches string")
    docs = documents(TEXTS).withColumnRenamed("extra", "matches")
    found = find_matches(docs, items, block_bytes=block_bytes)
    assert found.columns == [c for c in docs.columns if c != "matches"] + ["n_words", "matches"]
    for r in found.collect():
        for m in r.matches:
            item = [t for i, t in ITEMS if str(i) == str(m.item_id)]
            span = words(r.text)[m.doc_start:m.doc_start + m.n_words]
            assert any(words(t)[m.item_start:m.item_start + m.n_words] == span for t in item)
    assert rows_of(summary(docs, items)) == brute(TEXTS, ITEMS)


def test_matches_are_as_long_as_can_be(documents, spark):
    items = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(30)))], "item_id long, text string")
    text = "x " + " ".join(f"w{i}" for i in range(5, 25)) + " y"
    (row,) = find_matches(documents([(1, text)]), items).collect()
    assert [tuple(m) for m in row.matches] == [("1", 5, 1, 20)]


def test_table(table):
    docs, items = table("documents"), table("benchmark")
    pairs = [(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()]
    assert rows_of(summary(docs, items)) == brute(*pairs)


def test_random_texts_of_few_words(documents, spark):
    rng = random.Random(9)
    items = [(k, " ".join(rng.choice("abcd") for _ in range(rng.randrange(1, 25)))) for k in range(12)]
    texts = [(k, " ".join(rng.choice("abcde") for _ in range(rng.randrange(0, 300)))) for k in range(25)]
    got = summary(documents(texts), spark.createDataFrame(items, "item_id long, text string"))
    assert rows_of(got) == brute(texts, items)


def test_removal_keeps_columns_and_clean_rows(documents, spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = documents(TEXTS).withColumnRenamed("extra", "n_words")
    kept = remove_contaminated(docs, items)
    assert kept.columns == docs.columns
    clean = [row[0] for row in brute(TEXTS, ITEMS) if not row[5]]
    assert sorted(str(r.doc_id) for r in kept.collect()) == clean
    assert all(r.n_words.startswith("x") for r in kept.collect())


def test_empty_tables(documents, spark):
    items = spark.createDataFrame([], "item_id long, text string")
    assert rows_of(summary(documents([(1, "some words")]), items)) == brute([(1, "some words")], [])
    assert summary(documents([]), items).collect() == []
    assert remove_contaminated(documents([(1, "some words")]), items).count() == 1


def test_repetitive_texts_are_covered_by_few_matches(documents, spark):
    """An item of one repeated word in a document of a million of them: every place is hit, and what
    is found grows with the document and not with its product with the item."""
    texts = [(1, "la " * 1_000_000), (2, "la " * 9), (3, "x " + "la lo " * 50_000), (4, "la " * 1500 + "y " + "la " * 10)]
    items = spark.createDataFrame([(1, "la " * 1000), (2, "la lo " * 400), (3, "la " * 10)], "item_id long, text string")
    start = time.perf_counter()
    rows = {r.doc_id: r for r in find_matches(documents(texts), items, keep_text=False).collect()}
    assert time.perf_counter() - start < 90
    assert sum(m.item_id == "1" for m in rows[1].matches) <= 1100 and rows[2].matches == []
    assert all(m.n_words == 10 for m in rows[1].matches if m.item_id == "3")
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in summary(documents(texts), items).collect()}
    assert got == {1: (1_000_000, 1_000_000, 2), 2: (9, 0, 0), 3: (100_001, 100_000, 1), 4: (1511, 1510, 2)}
