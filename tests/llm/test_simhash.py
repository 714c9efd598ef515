"""SimHash near duplicates and components against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tallyline.llm import simhash
from tallyline.llm.components import components
from tallyline.llm.simhash import fingerprint, keep_one, near_duplicates

_AZ = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_AZ))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints):
    """prints: list of (id, fingerprint) -> smallest id reachable, by position."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    ids = {}
    for k, (i, _) in enumerate(prints):
        if i is not None:
            ids[find(k)] = min(i, ids.get(find(k), i))
    return [ids.get(find(k)) for k in range(len(prints))]


@pytest.mark.parametrize("text", ["", None, "one", "One  TWO", "a b c", "a b c d a b c", "x\x0by\x0cz w v", "É é " * 40, "w " * 5000])
def test_fingerprint(text):
    assert fingerprint(text) % (1 << 64) == brute_print(text)


def test_table_matches_brute_force(table):
    docs = table("documents")
    rows = docs.select("doc_id", "text").collect()
    prints = [(r.doc_id, brute_print(r.text)) for r in rows]
    want = {r[0]: (format(r[1], "016x"), c) for r, c in zip(prints, brute_groups(prints))}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in near_duplicates(docs).collect()} == want


def test_edge_rows(documents):
    rows = [(5, ""), (4, None), (7, "alpha beta gamma delta"), (7, "alpha beta gamma delta"), (None, "alpha beta gamma delta"),
            (None, "nobody else says this"), (2, "something else at all"), (7, "the same id with another text")]
    got = sorted((str(r.doc_id), r.fingerprint, r.component_id if r.component_id is not None else -1)
                 for r in near_duplicates(documents(rows)).collect())
    prints = [(i, brute_print(t)) for i, t in rows]
    want = sorted((str(i), format(p, "016x"), -1 if c is None else c) for (i, p), c in zip(prints, brute_groups(prints)))
    assert got == want
    assert near_duplicates(documents([])).collect() == []


def _as_fps(spark, values):
    return spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long")


def near_values(rng):
    values = set()
    for _ in range(25):
        v = rng.getrandbits(64)
        for _ in range(rng.choice((1, 2, 30))):
            values.add(v)
            for _ in range(rng.choice((1, 2, 3))):
                v ^= 1 << rng.randrange(64)
    return sorted(values)


@pytest.mark.parametrize("limit, deepest", [(256, 5), (12, 5), (2, 2), (1, 1)])
def test_links_connect_what_two_bits_connect(spark, monkeypatch, limit, deepest):
    """With lists of one byte, of split ones, and with dense groups that no byte splits further."""
    monkeypatch.setattr(simhash, "LIST", limit)
    monkeypatch.setattr(simhash, "DEEPEST", deepest)
    values = near_values(random.Random(limit))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    stars = {r.node: r.root for r in components(simhash._links(_as_fps(spark, values), 2)).collect()}
    groups = brute_groups([(s, v) for s, v in sorted(zip(signed, values))])
    got = {s: stars.get(s, s) for s in signed}
    assert [got[s] for s in sorted(signed)] == groups


@pytest.mark.parametrize("most", [0, 1, 2])
def test_lists_hold_every_near_pair_once_split(most):
    """Begun at a depth or split down to it, the lists are the same, and each near pair shares one."""
    rng = random.Random(most)
    fps = np.array(near_values(rng), np.uint64).view(np.int64)
    order = np.array(rng.sample(range(2048), 2048))
    import pyarrow as pa

    def lists_of(batch):
        return {(f, n) for f, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())}
    now = list(simhash._postings(order, 1, most)([pa.RecordBatch.from_arrays([pa.array(fps)], names=["fp"])]))
    near = [(a, b) for a in fps.tolist() for b in fps.tolist() if a < b and (a ^ b).bit_count() <= most and (a ^ b) >= 0]
    for depth in range(1, 6):
        want = set().union(*map(lists_of, simhash._postings(order, depth, most)(
            [pa.RecordBatch.from_arrays([pa.array(fps)], names=["fp"])])))
        got = set().union(*map(lists_of, now))
        assert got == want
        of = {}
        for f, n in got:
            of.setdefault(f, set()).add(n)
        assert all(of[a] & of[b] for a, b in near)
        now = list(simhash._split(order, depth, most)(now))


def test_count_filter_decides_what_is_verified():
    rng = random.Random(4)
    fps = np.array([rng.getrandbits(64) for _ in range(200)] + near_values(rng), np.uint64).view(np.int64)
    lists = np.sort(np.array([rng.randrange(5) for _ in fps]))

    def pairs(least):
        return {(int(a), int(b)) for x, y in simhash.tally(lists, fps, least) for a, b in zip(x, y)}
    every, kept = pairs(0), pairs(6)
    assert every == {(a, b) for a in range(len(fps)) for b in range(a + 1, len(fps)) if lists[a] == lists[b]}
    raw = [int(f).to_bytes(8, "little", signed=True) for f in fps]
    assert kept == {(a, b) for a, b in every if sum(p == q for p, q in zip(raw[a], raw[b])) >= 6}
    assert len(kept) < len(every) / 10
    def near(a, b):
        return bin(int.from_bytes(raw[a], "little") ^ int.from_bytes(raw[b], "little")).count("1") <= 2
    assert {p for p in every if near(*p)} == {p for p in kept if near(*p)}  # the filter loses none
    assert any(not near(*p) for p in kept)  # and verification still has something to refuse


def test_a_list_may_run_over_batches():
    import pyarrow as pa
    lists = np.repeat(np.arange(40), np.random.default_rng(1).integers(1, 9, 40))
    fps = np.arange(len(lists), dtype=np.int64) % 7

    def links(size):
        cut = [pa.RecordBatch.from_arrays([pa.array(lists[i:i + size]), pa.array(fps[i:i + size])], names=["list", "fp"])
               for i in range(0, len(lists), size)]
        return [r for b in simhash._verified(2)(iter(cut)) for r in b.to_pylist()]
    assert links(1) == links(5) == links(1000) != []
    assert list(simhash._verified(2)(iter([])))[0].num_rows == 0


def test_components_of_a_long_path_and_repeats(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 99), (99, 100), (100, 100), (7, 7), (None, 3)]
    rng = random.Random(2)
    rng.shuffle(links)
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 100: 99}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_keep_one(documents):
    rows = [(3, "alpha beta gamma delta"), (1, "alpha beta gamma delta"), (1, "alpha beta gamma delta"), (2, "other words are here"),
            (None, "alpha beta gamma delta"), (None, "only a row without id"), (None, "only a row without id"), (9, "")]
    docs = documents(rows).withColumnRenamed("extra", "text_key")
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == sorted(
        [("1", rows[1][1]), ("2", rows[3][1]), ("None", rows[5][1]), ("9", "")])
    assert keep_one(documents([])).count() == 0


def test_no_python_rows_and_no_cross_join(documents):
    plan = near_duplicates(documents([(1, "a b c d"), (2, "a b c e")])).select(F.col("doc_id"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
