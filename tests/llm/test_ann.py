"""Nearest neighbours against brute force: exact on small tables, recall on larger ones."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyline.llm import ann
from tallyline.llm.ann import Scan, beta_edge, nearest

SCHEMA = "vec_id long, embedding array<float>, rank string, score int"


def brute(rows, k=20, every=20):
    """Rows of (id, list) to {(query id, vector): [(id, score)]} by falling score."""
    good = {(i, tuple(np.array(e, np.float32))) for i, e in rows if i is not None and e and all(x is not None and np.isfinite(x) for x in e) and any(e)}
    size = max((len(e) for _, e in good), default=0)
    good = sorted({(i, e + (np.float32(0),) * (size - len(e))) for i, e in good})
    x = np.array([e for _, e in good], np.float64).reshape(len(good), size)
    out = {}
    for q, (i, e) in enumerate(good):
        if i % every == 0:
            s = (x * x[q]).sum(1)
            order = sorted((j for j in range(len(good)) if j != q), key=lambda j: (-s[j], good[j][0]))[:k]
            out.setdefault(i, []).append([(good[j][0], round(float(s[j]), 9)) for j in order])
    return {i: sorted(v) for i, v in out.items() if any(v)}


def found(df):
    assert df.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, round(r.score, 9)))
        assert r.rank == len(out[r.query_id])
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, e, "x", 1) for i, e in rows], SCHEMA)


def asked():
    return F.col("vec_id") % 20 == 0



def test_edge_rows(spark):
    rows = [(20, [1.0, 0.0]), (2, [2.0, 0.0]), (40, [1.0, 0.0]), (40, [1.0, 0.0]), (9, [1.0, 0.0, 0.0]), (60, None), (80, []), (100, [0.0, 0.0]),
            (120, [1.0, float("nan")]), (140, [float("inf"), 1.0]), (160, [1.0, None]), (None, [1.0, 0.01]), (12, [1e15, 1e-15]), (0, [-0.0, 5.0]),
            (180, [-1.0, -1.0, -1.0]), (-20, [0.5])]
    rows += [(k, [3.0, 4.0]) for k in range(1001, 1100, 2)]  # copies: the smallest ids count
    want = {i: v[0] for i, v in brute(rows).items()}
    assert found(nearest(frame(spark, rows), asked())) == want
    assert found(nearest(frame(spark, []), asked())) == {} == found(nearest(frame(spark, [(20, [0.0]), (1, None)]), asked()))
    assert found(nearest(frame(spark, [(20, [1.0])]), asked())) == {}
    assert found(nearest(frame(spark, rows), F.col("score") > 5)) == {}


def test_one_id_with_two_vectors(spark):
    rows = [(20, [1.0, 0.0]), (20, [0.0, 1.0]), (3, [0.5, 0.25])]
    got = nearest(frame(spark, rows), asked()).collect()
    assert sorted((r.rank, r.vec_id, r.score) for r in got) == [(1, 3, 0.25), (1, 3, 0.5), (2, 20, 0.0), (2, 20, 0.0)]


@pytest.mark.parametrize("kind", ["groups", "lengths"])
def test_recall_with_many_lists(spark, monkeypatch, kind):
    """Small cells and blocks, lists cut into pieces, a third of all rows copies, few probes."""
    rng = np.random.default_rng(4)
    size, n = 40, 5000
    if kind == "groups":
        x = rng.standard_normal((60, size))[rng.integers(0, 60, n)] + 0.6 * rng.standard_normal((n, size))
    else:  # inner products of vectors whose lengths differ by a factor of ten
        x = rng.standard_normal((n, size)) * rng.uniform(0.3, 3, (n, 1))
    x[rng.random(n) < 0.33] = x[0]
    for name, value in {"LEAST": 1, "CELL_BYTES": 8 * size * 300, "SAMPLE": 2000, "PAIRS": 5000}.items():
        monkeypatch.setattr(ann, name, value)
    rows = [(k, v.astype(np.float32).tolist()) for k, v in enumerate(x)]
    got, want = found(nearest(frame(spark, rows), asked())), {i: v[0] for i, v in brute(rows).items()}
    assert got.keys() == want.keys() and all(len(got[q]) == 20 for q in got)
    exact = {(q, i): s for q, v in want.items() for i, s in v}
    hits = [(q, i) in exact for q, v in got.items() for i, _ in v]
    assert np.mean(hits) >= 0.9
    assert all(abs(exact.get((q, i), s) - s) < 1e-6 for q, v in got.items() for i, s in v)
    assert all(v == sorted(v, key=lambda r: (-r[1], r[0])) for v in got.values())


def test_tests_abandon_early_and_keep_the_best():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    q = x[:50] + 0.05 * rng.standard_normal((50, 64))
    index = ann._fit(x, len(x), 1.0, 1, 10)
    scores = q @ x.T
    bar = np.sort(scores, axis=1)[:, -10] - 1e-12
    scan = Scan(index, x, np.arange(3000), q, bar, 10)
    scan.compare(np.arange(50), np.arange(3000))
    i, j, s = scan.cut()
    assert scan.abandoned > 0.99 * 50 * 3000
    assert sum(set(j[i == k]) == set(np.argsort(-scores[k])[:10]) for k in range(50)) >= 49
    assert index.edges[-1] == 65 and np.all(np.diff(index.shares) > 0)


def test_beta_edge():
    draws = np.random.default_rng(1).beta(8, 24.5, 400_000)
    assert abs((draws > beta_edge(8, 24.5, 0.01)).mean() - 0.01) < 0.001


def test_table(spark, table):
    df = table("embeddings")
    want = {i: v[0] for i, v in brute([(r.vec_id, r.embedding) for r in df.collect()]).items()}
    assert found(nearest(df, asked())) == want
