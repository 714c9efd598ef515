"""The trie of conversations against a brute-force one, and its queue against a sorted list."""

import hashlib
import random
import re
import zlib

import pytest

from tallyline.llm import conv_trie
from tallyline.llm.conv_trie import Messages, numbered_turns, plain_paths, prefix_trie, with_shared_heads

SCHEMA = "conv_id long, turn long, role string, text string, depth int, k1 string"


def brute(rows, shared=True):
    turns = {}
    for c, n, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            code = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            turns.setdefault(c, []).append((n is not None, n or 0, code, role, text))
    turns = {c: [t[3:] for t in sorted(ts)] for c, ts in turns.items()}
    paths = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4 if shared else 0
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        paths[c] = tuple(turns.get(base, [])[:h] + own[h:])
    members = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    totals = {}
    for node in sorted(members, key=len, reverse=True):
        kids = [k for k in totals if len(k) == len(node) + 1 and k[:-1] == node]
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        totals[node] = (len(kids), sum(totals[k][1] for k in kids) or 1,
                        (len(members[node]) - 1) * words + sum(totals[k][2] for k in kids))
    out = []
    for node, cs in members.items():
        ends = ",".join(str(c) for c in sorted(cs) if len(paths[c]) == len(node))
        out.append((min(cs), len(node), min(members[node[:-1]]) if node else None, len(cs), *totals[node],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def trie(spark, rows, shared=True, **options):
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA)
    turns = numbered_turns(df)
    paths = with_shared_heads(turns) if shared else plain_paths(turns)
    return sorted((tuple(r) for r in prefix_trie(paths, **options).collect()), key=str)


def talks(n, seed, depth=6, words=("a", "b c", "", " \t", "é x y")):
    rng = random.Random(seed)
    return [(c, t, rng.choice(("user", "bot")), rng.choice(words)) for c in range(n) for t in range(rng.randint(1, depth))]


def test_columns(spark):
    df = prefix_trie(with_shared_heads(numbered_turns(spark.createDataFrame([], SCHEMA))))
    assert df.dtypes == [(c, "bigint") for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")] + [
        ("ends_sha256", "string")]
    assert df.collect() == []


@pytest.mark.parametrize("light, upper, capacity", [(3, 4096, 3), (0, 10 ** 9, 1000)])
def test_random_talks(spark, light, upper, capacity):
    """Shards below upper nodes with queues that spill, and upper nodes alone."""
    rows = talks(90, 1)
    assert trie(spark, rows, light=light, upper=upper, capacity=capacity) == brute(rows)


def test_edges(spark):
    rows = [(None, 0, "user", "lost"), (5, None, "user", "first"), (5, 0, None, None), (5, 0, "a", "b"), (5, 0, "a", "b"),
            (25, 3, "user", "x y"), (20, 1, "user", "x y"), (-7, 1, "user", "q"), (-3, 9, "", ""), (0, -4, "u", "z"), (0, None, "u", "z"),
            (10 ** 15, 1, "u:", "s"), (10 ** 15 + 1, 1, "u", ":s"), (61, 2, "u", "w " * 5000)]
    assert trie(spark, rows) == brute(rows)
    assert trie(spark, rows, shared=False) == brute(rows, shared=False)


def test_copies_and_a_common_first_turn(spark):
    rows = [(c, t, "user", f"same {t}") for c in range(0, 400) for t in range(2)]
    rows += [(c, t, "user", "hello" if t == 0 else f"{c}") for c in range(400, 600) for t in range(2)]
    assert trie(spark, rows, light=20, upper=10 ** 9) == brute(rows)


def test_stretches(spark, monkeypatch):
    """A long conversation in stretches gives what it gives in one piece."""
    rows = talks(12, 5, depth=40) + [(3, None, "user", "early")] + [(4, 1, "user", f"again {k}") for k in range(5)]
    monkeypatch.setattr(conv_trie, "STRETCH", 4)
    assert trie(spark, rows) == brute(rows)


def test_queue_spills_and_merges():
    rng = random.Random(3)
    queue, sums = Messages(capacity=10), {}
    for _ in range(3000):
        key = (rng.randint(-3, 0), rng.randint(-5, 5), rng.randint(-5, 5))
        sums[key] = tuple(a + b for a, b in zip(sums.get(key, (0, 0, 0)), (1, key[1], 2)))
        queue.push(*key, 1, key[1], 2)
    assert queue.spilled > conv_trie.RUNS
    assert [queue.take(*key) for key in sorted(sums)] == [sums[key] for key in sorted(sums)]
    assert queue.take(1, 1, 1) == (0, 0, 0) and not queue.heap and not queue.runs


def test_table(table):
    df = table("conversations")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in df.collect()]
    got = prefix_trie(with_shared_heads(numbered_turns(df)), light=2)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)
