"""All similar pairs against brute force, with hot keys, copies and bounds."""

import math
import random

import pytest

from tallyline.operators import similar
from tallyline.operators.similar import candidate_pairs, distinct_vectors, similar_pairs, vector_classes


def cosine(a, b):
    size = lambda v: math.sqrt(sum(w * w for w in v.values()))
    return sum(a[k] * b[k] for k in a if k in b) / (size(a) * size(b)) if size(a) and size(b) else None


def pearson(a, b, shared):
    keys = [k for k in a if k in b]
    n = len(keys)
    if n < shared:
        return None
    xs, ys = [a[k] for k in keys], [b[k] for k in keys]
    den = math.sqrt(abs(sum(x * x for x in xs) - sum(xs) ** 2 / n) * abs(sum(y * y for y in ys) - sum(ys) ** 2 / n))
    return (sum(x * y for x, y in zip(xs, ys)) - sum(xs) * sum(ys) / n) / den if den else 0.0


def brute(vectors, least, measure="cosine", shared=2):
    first, copies = {}, {}
    for i, v in sorted(vectors):
        body = tuple(sorted(v.items()))
        first.setdefault(body, i)
        copies[first[body]] = copies.get(first[body], 0) + 1
    reps = sorted((i, dict(body)) for body, i in first.items())
    out = []
    for x, (a, va) in enumerate(reps):
        for b, vb in reps[x + 1:]:
            s = cosine(va, vb) if measure == "cosine" else pearson(va, vb, shared)
            if s is not None and s >= least:
                out.append((a, b, round(s, 9), copies[a], copies[b]))
    return sorted(out)


def frame(spark, vectors):
    return spark.createDataFrame(vectors, "id long, vector map<long,double>")


def found(df):
    return sorted((r.a, r.b, round(r.similarity, 9), r.copies_a, r.copies_b) for r in df.collect())


def world(n=220, seed=3, keys=25, negative=True):
    """Vectors of up to six keys of which two are in most of them, and a third of all alike."""
    r = random.Random(seed)
    pick = lambda: r.choice([-2.0, -1.0, 0.0, 0.5, 1.0, 1.5, 3.0] if negative else [0.5, 1.0, 1.5, 3.0])
    out = []
    for i in range(n):
        v = {k: pick() for k in r.sample(range(keys), r.randint(0, 6))} | {100 + k: pick() for k in range(2) if r.random() < 0.8}
        out.append((i, {1: 1.0, 100: 2.0} if r.random() < 0.33 else v))
    return out


@pytest.mark.parametrize("block", [2000, 7])
def test_cosine_matches_brute_force(spark, monkeypatch, block):
    """Also with lists of many blocks."""
    monkeypatch.setattr(similar, "BLOCK", block)
    vectors = world()
    assert found(similar_pairs(frame(spark, vectors), 0.8)) == brute(vectors, 0.8)


@pytest.mark.parametrize("shared", [2, 3])
def test_pearson_matches_brute_force(spark, shared):
    vectors = world(120, 5, keys=10)
    assert found(similar_pairs(frame(spark, vectors), 0.9, "pearson", shared)) == brute(vectors, 0.9, "pearson", shared)


def test_edges(spark):
    vectors = [(1, {}), (2, {5: 0.0}), (3, {5: 2.0}), (4, {5: 2.0}), (9, {5: 1.0}), (7, {6: -1.0}), (8, {6: 1.0})]
    assert found(similar_pairs(frame(spark, vectors), 1e-6)) == [(3, 9, 1.0, 2, 1)]
    messy = frame(spark, [*vectors, (None, {5: 1.0}), (11, None)])
    assert found(similar_pairs(messy, 0.5)) == [(3, 9, 1.0, 2, 1)]
    assert found(similar_pairs(frame(spark, []), 0.5)) == []
    assert sorted(tuple(r) for r in vector_classes(messy).collect()) == [(1, 1), (2, 2), (3, 3), (4, 3), (7, 7), (8, 8), (9, 9)]
    for bad in ({"least": 0.0}, {"least": 0.5, "measure": "dot"}, {"least": 0.5, "shared": 1}):
        with pytest.raises(ValueError):
            similar_pairs(messy, **bad)


def test_bounds_keep_pairs_from_the_shuffle(spark):
    """Far fewer candidates than pairs that share a key, and hardly any without the threshold."""
    vectors = world(300, 8, negative=False)
    known = distinct_vectors(frame(spark, vectors))
    reps = [(r.id, r.vector) for r in known.collect()]
    sharing = sum(any(k in b for k in a) for x, (_, a) in enumerate(reps) for _, b in reps[x + 1:])
    n = candidate_pairs(known.select("id", "vector"), 0.95).count()
    assert len(brute(vectors, 0.95)) <= n < sharing / 10
    plan = candidate_pairs(known.select("id", "vector"), 0.95)._jdf.queryExecution().optimizedPlan().toString()
    join = next(line for line in plan.splitlines() if "Join Inner" in line)
    assert "_rx" in join and "_wy" in join  # the bound is part of the join, below the exchange of the pairs


def test_a_hot_key_meets_in_blocks(spark, monkeypatch):
    """A key of all vectors, in which every pair is alike, is spread over block pairs of bounded size."""
    monkeypatch.setattr(similar, "BLOCK", 20)
    vectors = [(i, {1: 1.0 + i / 1000}) for i in range(200)]
    assert len(found(similar_pairs(frame(spark, vectors), 0.99))) == 200 * 199 // 2


@pytest.mark.parametrize("measure", ["pearson", "cosine"])
def test_vectors_that_share_one_key_are_no_candidates(spark, measure):
    """Short vectors over few keys: hardly a pair is built that shares only the key at which it meets."""
    r = random.Random(4)
    vectors = [(i, {k: 1.0 + r.random() for k in r.sample(range(60), 4)}) for i in range(300)]
    shared = {(a, b): len(va.keys() & vb.keys()) for a, va in vectors for b, vb in vectors if a < b}
    pairs = {tuple(p) for p in candidate_pairs(frame(spark, vectors), 0.5, measure).collect()}
    if measure == "pearson":
        assert {p for p, n in shared.items() if n > 1} <= pairs
    assert sum(shared[p] == 1 for p in pairs) < 0.1 * sum(n == 1 for n in shared.values())
    assert {p[:2] for p in brute(vectors, 0.5, measure)} <= pairs
