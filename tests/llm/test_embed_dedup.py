"""The forest against brute force."""

import numpy as np
import pytest

from tallyline.llm.embed_dedup import LEAF, Tree, near_duplicates

SCHEMA = "vec_id long, embedding array<float>, label int, vec string"


def brute(rows, least=0.9):
    ok = [e is not None and len(e) > 0 and all(x is not None and np.isfinite(x) for x in e) and any(e) for _, e in rows]
    size = max((len(e) for (_, e), good in zip(rows, ok) if good), default=1)
    unit = np.zeros((len(rows), size))
    for k, (_, e) in enumerate(rows):
        if ok[k]:
            v = np.array(e, np.float32).astype(float)
            unit[k, :len(v)] = v / np.linalg.norm(v)
    linked = (unit @ unit.T >= least) & np.outer(ok, ok)
    np.fill_diagonal(linked, False)
    root = np.arange(len(rows))
    while True:
        low = np.array([min(root[k], *root[linked[k]]) if linked[k].any() else root[k] for k in range(len(rows))], int)
        low = low[low] if len(low) else low
        if (low == root).all():
            break
        root = low
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root[j] == root[k] and rows[j][0] is not None]
        component = min(ids) if ids else None
        out.append((str(i), int(linked[k].sum()), str(component), i == component))
    return sorted(out)


def rows_of(df):
    return sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in df.collect())


def clustered(rng, n, groups, noise, size=32):
    centres = rng.standard_normal((groups, size))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    return [(k, (centres[rng.integers(groups)] + noise * rng.standard_normal(size)).astype(np.float32).tolist()) for k in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, e, 0, "x") for i, e in rows], SCHEMA)


def test_edge_rows(spark):
    rows = [(4, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [1.0, 0.0]), (9, [1.0, 0.0, 0.0]), (5, None), (6, []), (7, [0.0, 0.0]),
            (8, [1.0, float("nan")]), (10, [float("inf"), 1.0]), (11, [1.0, None]), (None, [1.0, 0.01]), (None, [0.0, -1.0]),
            (12, [1e30, 1e-30]), (13, [-0.0, 5.0])]
    assert rows_of(near_duplicates(frame(spark, rows))) == brute(rows)
    assert near_duplicates(frame(spark, [])).collect() == []
    assert rows_of(near_duplicates(frame(spark, [(1, None), (2, [0.0])]))) == [("1", 0, "1", True), ("2", 0, "2", True)]


def test_table(table):
    rows = [(r.vec_id, r.embedding) for r in table("embeddings").collect()]
    assert rows_of(near_duplicates(table("embeddings"))) == brute(rows)


def recall(got, want):
    return sum(min(g[1], w[1]) for g, w in zip(got, want)) / sum(w[1] for w in want)


def test_deep_trees_reach_the_recall_that_is_asked_for(spark):
    rows = clustered(np.random.default_rng(1), 1500, 300, 0.04)
    got, want = rows_of(near_duplicates(frame(spark, rows), leaf=100)), brute(rows)
    assert all(g[1] <= w[1] for g, w in zip(got, want))  # a pair is never counted twice, and none below the threshold
    assert recall(got, want) > 0.99
    assert sum(g[2] == w[2] for g, w in zip(got, want)) > 0.99 * len(rows)


def test_leaves_are_split_again(spark, monkeypatch):
    """A sample too small to resolve the leaves makes a second round necessary."""
    from tallyline.llm import embed_dedup
    monkeypatch.setattr(embed_dedup, "SAMPLE", 40)
    rows = clustered(np.random.default_rng(2), 1200, 240, 0.04)
    got, want = rows_of(near_duplicates(frame(spark, rows), leaf=120)), brute(rows)
    assert all(g[1] <= w[1] for g, w in zip(got, want)) and recall(got, want) > 0.9


def test_one_tight_group_of_many(spark):
    rng = np.random.default_rng(3)
    rows = clustered(rng, 700, 1, 0.01) + [(700 + k, e) for k, e in clustered(rng, 300, 150, 0.02)]
    got, want = rows_of(near_duplicates(frame(spark, rows))), brute(rows)
    assert got == want  # all in one leaf


def test_a_tree_files_every_vector():
    x = np.random.default_rng(4).standard_normal((5000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows, leaves = Tree(x[:1000], 5.0, 200, [1]).file(x)
    assert set(rows.tolist()) == set(range(5000)) and np.bincount(leaves).max() < LEAF
    same = np.repeat(x[:1], 500, axis=0)
    assert set(Tree(same, 10.0, 100, [1]).file(same)[0].tolist()) == set(range(500))


@pytest.mark.parametrize("least", [0.5, 0.99])
def test_other_thresholds(spark, least):
    rows = clustered(np.random.default_rng(6), 300, 60, 0.05)
    assert rows_of(near_duplicates(frame(spark, rows), least=least)) == brute(rows, least)


@pytest.mark.parametrize("n, others", [(1000, 0), (600, 600)])
def test_groups_of_several_times_a_leaf_are_exact(spark, n, others):
    """Near copies that no leaf can hold keep all their links."""
    rng = np.random.default_rng(8)
    rows = clustered(rng, n, 1, 0.045) + [(n + k, e) for k, e in clustered(rng, others, max(1, others // 3), 0.02)]
    got, want = rows_of(near_duplicates(frame(spark, rows), leaf=150)), brute(rows)
    assert all(g[1] <= w[1] for g, w in zip(got, want))
    in_group = {str(k) for k in range(n)}
    assert [g for g in got if g[0] in in_group] == [w for w in want if w[0] in in_group]
    assert recall(got, want) > 0.999


def test_groups_that_stand_apart_are_split_off():
    rng = np.random.default_rng(9)
    x = np.array([e for _, e in clustered(rng, 4000, 4, 0.01)])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    tree = Tree(x, 1.0, 1300, [1])
    rows, leaves = tree.file(x)
    assert set(rows.tolist()) == set(range(4000)) and not tree.dense and np.bincount(leaves).max() < 1300
