"""Prefix trie of conversations, with subtree totals by time-forward processing.

A node is a distinct sequence of first turns. It is named by its depth and two 64-bit hashes that
take in one turn after the other by exclusive or of (depth, MD5 of role and text), so that prefixes
of a conversation can be computed in pieces; texts are read once, by the scan, and are never
shuffled. Nodes are aggregated from the rows (conversation, depth) and combine before the shuffle:
a first turn that a third of all conversations share is one row per input partition.

Totals of subtrees need children before parents. Nodes are cut into shards and sorted externally by
falling depth; a task reads its shard once in that order and sends the totals of a node forward to
its parent through a priority queue ordered alike, whose entries beyond ``QUEUE`` are written in
sorted runs. Shards are whole subtrees below the nodes with many members; those nodes are at most
``UPPER`` by construction (a node with more than rows / ``UPPER`` members, while all members of all
nodes are the rows) and are processed last in the same way, from the summed totals of shard roots.
"""

from __future__ import annotations

import hashlib
import heapq
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.common import dealt, saved

STRETCH = 1024     # turns of a conversation that are numbered and hashed together
LIGHT = 64         # members of a node that a shard may always hold
UPPER = 4096       # nodes above the shards, at most
QUEUE = 100_000    # messages that a queue holds in memory
RUNS = 32          # sorted runs of a queue before they are merged
ENDS = 12          # bits of a conv_id that are summed up to one piece of text before hashing
WORD = r"[^\x20\x09-\x0D]+"

_KEY = ["depth", "k1", "k2"]


def _earlier(pieces: DataFrame, value: Column, out: str) -> DataFrame:
    """``value`` over the earlier stretches of a conversation, where there are any."""
    before = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    return pieces.withColumn(out, value.over(before)).where(F.col(out).isNotNull()).select("conv_id", "stretch", out)


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, code, words): the turns of each conversation from 1 on.

    They are ordered by ``turn``, null first; turns with equal numbers by the MD5 of their role and
    text, so that repeated rows are turns of their own and the result never depends on row order. A
    null role or text is the empty one. Rows without a conv_id belong to no conversation. A long
    conversation is numbered by stretches of turn numbers, not in one task.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = saved(conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("code"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
        .withColumn("stretch", F.coalesce(F.floor(F.col("turn") / STRETCH), F.lit(-(1 << 62)))), "turns")
    inside = Window.partitionBy("conv_id", "stretch").orderBy(F.asc_nulls_first("turn"), "code")
    sizes = turns.groupBy("conv_id", "stretch").agg(F.count("*").alias("n"))
    earlier = saved(_earlier(sizes, F.sum("n"), "before"), "earlier")
    return (turns.withColumn("pos", F.row_number().over(inside)).join(earlier, ["conv_id", "stretch"], "left")
            .select("conv_id", (F.col("pos") + F.coalesce("before", F.lit(0))).alias("pos"), "code", "words"))


def with_shared_heads(turns: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Rebuild each conversation c of :func:`numbered_turns`: its first h turns are those of
    conversation c - c % ``every`` (as many as that has), its own after the first h follow, where h
    is crc32(c as text) % ``most``.

    (conv_id, depth, code, words, length): depth 0 for the conversation itself, also one without
    any turn left, and a row per turn.
    """
    turns = saved(turns, "numbered")
    c = F.col("conv_id")
    heads = (turns.where((c % every == 0) & (F.col("pos") < most)).groupBy(c.alias("base"))
             .agg(F.array_sort(F.collect_list(F.struct("pos", "code", "words"))).alias("head")))
    whole = (turns.groupBy("conv_id").agg(F.count("*").alias("n"))
             .withColumns({"base": c - c % every, "h": (F.crc32(c.cast("string")) % most).cast("int")})
             .join(heads, "base", "left")
             .withColumn("head", F.when(F.col("head").isNotNull(), F.slice("head", 1, F.col("h")))
                         .otherwise(F.slice(F.array(F.struct(F.lit(0).cast("long").alias("pos"), F.lit(b"").alias("code"),
                                                             F.lit(0).cast("long").alias("words"))), 1, 0)))
             .withColumn("length", F.size("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))))
    whole = saved(whole.select("conv_id", "h", "head", "length"), "rebuilt")
    start = whole.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("code"),
                         F.lit(0).cast("long").alias("words"), "length")
    shared = (whole.select("conv_id", F.posexplode("head").alias("p", "t"), "length")
              .select("conv_id", (F.col("p") + 1).cast("long").alias("depth"), "t.code", "t.words", "length"))
    own = (turns.join(whole.select("conv_id", "h", F.size("head").alias("k"), "length"), "conv_id").where("pos > h")
           .select("conv_id", (F.col("pos") - F.col("h") + F.col("k")).alias("depth"), "code", "words", "length"))
    return start.unionByName(shared).unionByName(own)


def plain_paths(turns: DataFrame) -> DataFrame:
    """The conversations of :func:`numbered_turns` as they are, in the columns of :func:`with_shared_heads`."""
    turns = saved(turns, "numbered")
    whole = turns.groupBy("conv_id").agg(F.count("*").alias("length"))
    start = whole.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("code"),
                         F.lit(0).cast("long").alias("words"), "length")
    return start.unionByName(saved(whole, "lengths").join(turns, "conv_id").select(
        "conv_id", F.col("pos").alias("depth"), "code", "words", "length"))


def _keyed(paths: DataFrame) -> DataFrame:
    """Each row with the name of its node (k1, k2) and of the node above (p1, p2)."""
    first = F.col("depth") == 0
    rows = saved(paths.select(
        "conv_id", "depth", "words", (F.col("depth") == F.col("length")).alias("last"),
        F.when(first, 0).otherwise(F.xxhash64("depth", "code")).alias("h1"),
        F.when(first, 0).otherwise(F.xxhash64(F.lit("second"), "depth", "code")).alias("h2"),
        F.floor(F.col("depth") / STRETCH).alias("stretch")), "paths")
    inside = Window.partitionBy("conv_id", "stretch").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    pieces = rows.groupBy("conv_id", "stretch").agg(F.bit_xor("h1").alias("x1"), F.bit_xor("h2").alias("x2"))
    e1, e2 = (_earlier(pieces, F.bit_xor(x), e) for x, e in (("x1", "e1"), ("x2", "e2")))
    earlier = saved(e1.join(e2, ["conv_id", "stretch"]), "earlier")
    out = (rows.withColumns({"k1": F.bit_xor("h1").over(inside), "k2": F.bit_xor("h2").over(inside)})
           .join(earlier, ["conv_id", "stretch"], "left"))
    for i in "12":
        out = out.withColumn(f"k{i}", F.col(f"k{i}").bitwiseXOR(F.coalesce(f"e{i}", F.lit(0).cast("long"))))
    return out.select("conv_id", *_KEY, *[F.when(F.col("depth") > 0, F.col(f"k{i}").bitwiseXOR(F.col(f"h{i}"))).alias(f"p{i}") for i in "12"],
                      "words", "last")


class Messages:
    """A priority queue of (key, sums): the smallest key first, the sums of equal keys added up. A
    key is (-depth, k1, k2), the sums are children, leaves and tokens. What exceeds ``capacity`` is
    written as a sorted run to a file that only this task has and that vanishes with it."""

    def __init__(self, capacity: int = QUEUE):
        self.capacity, self.heap, self.runs, self.spilled = capacity, [], [], 0

    def push(self, *entry: int) -> None:
        heapq.heappush(self.heap, entry)
        if len(self.heap) > self.capacity:
            self._write(iter(sorted(self.heap)))
            self.heap = []
            self.spilled += 1
            if len(self.runs) > RUNS:
                old = [self._rest(run) for run in self.runs]
                self.runs = []
                self._write(heapq.merge(*old))

    @staticmethod
    def _rest(run) -> Iterator[tuple]:
        yield run[0]
        yield from run[2]

    def _write(self, entries: Iterator[tuple]) -> None:
        file, block, last = tempfile.TemporaryFile(), [], None
        for e in entries:
            if last is not None and last[:3] == e[:3]:
                last = (*last[:3], *(a + b for a, b in zip(last[3:], e[3:])))
                continue
            if last is not None:
                block.append(last)
            if len(block) >= 4096:
                file.write(np.array(block, np.int64).tobytes())
                block = []
            last = e
        file.write(np.array([*block, last], np.int64).tobytes())
        file.seek(0)

        def read() -> Iterator[tuple]:
            with file:
                while some := file.read(4096 * 48):
                    yield from map(tuple, np.frombuffer(some, np.int64).reshape(-1, 6).tolist())
        rows = read()
        heapq.heappush(self.runs, (next(rows), self.spilled, rows))

    def take(self, *key: int) -> tuple[int, int, int]:
        """Remove what was sent to ``key``, which must be the smallest key left, and add it up."""
        children = leaves = tokens = 0
        while self.heap and self.heap[0][:3] == key:
            _, _, _, c, n, t = heapq.heappop(self.heap)
            children, leaves, tokens = children + c, leaves + n, tokens + t
        while self.runs and self.runs[0][0][:3] == key:
            (_, _, _, c, n, t), number, rows = self.runs[0]
            children, leaves, tokens = children + c, leaves + n, tokens + t
            after = next(rows, None)
            if after is None:
                heapq.heappop(self.runs)
            else:
                heapq.heapreplace(self.runs, (after, number, rows))
        return children, leaves, tokens


def _settle(capacity: int):
    """Totals of the nodes of a shard, which come by falling depth; a ``top`` node sends nothing on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = Messages(capacity)
        for batch in batches:
            at = {n: batch.column(n).to_pylist() for n in ("depth", "k1", "k2", "p1", "p2", "top", "n_children", "n_leaves", "saved_tokens")}
            totals = []
            for d, k1, k2, p1, p2, top, children, leaves, tokens in zip(*at.values()):
                c, n, t = queue.take(-d, k1, k2)
                children, leaves, tokens = children + c, leaves + n, tokens + t
                leaves = leaves if children else 1
                totals.append((children, leaves, tokens))
                if not top and d:
                    queue.push(1 - d, p1, p2, 1, leaves, tokens)
            arrays = dict(zip(batch.schema.names, batch.columns))
            if totals:
                for name, values in zip(("n_children", "n_leaves", "saved_tokens"), zip(*totals)):
                    arrays[name] = pa.array(values, pa.int64())
            yield pa.RecordBatch.from_arrays(list(arrays.values()), names=list(arrays))
    return run


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the pieces of text of each node, which come in order; one is held at a time."""
    now, state = None, None
    for batch in batches:
        out = []
        for *key, body in zip(*[batch.column(c).to_pylist() for c in (*_KEY, "body")]):
            if key == now:
                state.update(b"," + body.encode())
            else:
                if now is not None:
                    out.append((*now, state.hexdigest()))
                now, state = key, hashlib.sha256(body.encode())
        yield _digests(out)
    if now is not None:
        yield _digests([(*now, state.hexdigest())])


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * 4
    return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.string())],
                                      names=[*_KEY, "ends_sha256"])


def _same(a: DataFrame, b: DataFrame, left: tuple[str, ...], right: tuple[str, ...]) -> Column:
    test = F.lit(True)
    for x, y in zip(left, right):
        test = test & (a[x] == b[y])
    return test


def prefix_trie(paths: DataFrame, light: int = LIGHT, upper: int = UPPER, capacity: int = QUEUE) -> DataFrame:
    """One row per node of the trie over the conversations of :func:`with_shared_heads` or
    :func:`plain_paths`: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the
    root), ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``, the hash
    of the conv_ids that end there. Without a conversation there is no root and no row.
    """
    rows = saved(_keyed(paths), "keyed")
    nodes = saved(rows.groupBy(*_KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("words").alias("words"),
        F.max("p1").alias("p1"), F.max("p2").alias("p2")), "nodes")
    total = nodes.agg(F.sum("n_convs")).first()[0] or 0
    limit = max(light, total // upper)  # nodes with more members are at most total / limit
    named = F.broadcast(nodes.where(F.col("n_convs") > limit).select(
        F.col("depth").alias("level"), (F.col("depth") + 1).alias("below"), F.col("k1").alias("u1"), F.col("k2").alias("u2"),
        F.col("conv_id").alias("upper_conv")))

    # The shard root of a node is the first node on the way to it that isn't an upper one; a node's
    # smallest member goes that way.
    is_upper = _same(rows, named, ("depth", "k1", "k2"), ("level", "u1", "u2"))
    roots = (rows.join(named, is_upper, "left_anti").groupBy("conv_id")
             .agg(F.min(F.struct(*_KEY)).alias("root")).select(F.col("conv_id").alias("member"), "root"))
    own = [F.lit(0).cast("long").alias("n_children"), F.lit(0).cast("long").alias("n_leaves"),
           ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens")]
    shape = [*_KEY, "p1", "p2", "conv_id", "n_convs", "top", "n_children", "n_leaves", "saved_tokens"]
    shards = (nodes.where(F.col("n_convs") <= limit).join(saved(roots, "roots"), F.col("conv_id") == F.col("member"))
              .withColumn("top", F.struct(*_KEY) == F.col("root")).withColumns(dict(zip(shape[-3:], own)))
              .select(*shape, F.col("root.k1").alias("r1"), F.col("root.k2").alias("r2")))
    schema = ", ".join(f"{c} {'boolean' if c == 'top' else 'long'}" for c in shape)
    below = (dealt(shards, "r1", "r2").select(*shape).sortWithinPartitions(F.desc("depth"), "k1", "k2")
             .mapInArrow(_settle(capacity), schema))
    below = saved(below, "below")
    sent = (below.where("top").groupBy((F.col("depth") - 1).alias("d"), F.col("p1").alias("s1"), F.col("p2").alias("s2"))
            .agg(F.count("*").alias("c"), F.sum("n_leaves").alias("n"), F.sum("saved_tokens").alias("t")))
    high = nodes.where(F.col("n_convs") > limit)
    high = high.join(sent, _same(high, sent, ("depth", "k1", "k2"), ("d", "s1", "s2")), "left").withColumn("top", F.lit(False))
    for name, first, more in zip(shape[-3:], own, "cnt"):
        high = high.withColumn(name, first + F.coalesce(more, F.lit(0)))
    above = (high.select(*shape).coalesce(1).sortWithinPartitions(F.desc("depth"), "k1", "k2")  # at most ``upper`` rows
             .mapInArrow(_settle(capacity), schema))

    # Parents: upper ones are few and may have any number of children; others are looked up by a
    # shuffle in which no key has more than ``limit`` rows.
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "k1", "k2"]
    near = below.where("top").unionByName(above)
    near = near.join(named, _same(near, named, ("depth", "p1", "p2"), ("below", "u1", "u2")), "left").withColumn("parent_conv_id", F.col("upper_conv"))
    up = nodes.select((F.col("depth") + 1).alias("below"), F.col("k1").alias("u1"), F.col("k2").alias("u2"), F.col("conv_id").alias("parent_conv_id"))
    far = below.where("NOT top")
    far = far.join(up, _same(far, up, ("depth", "p1", "p2"), ("below", "u1", "u2")))
    ends = (rows.where("last").groupBy(*_KEY, F.shiftright("conv_id", ENDS).alias("piece"))
            .agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))  # at most 2 ** ENDS of them
            .withColumn("body", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",")))
    ends = (dealt(ends.select(*_KEY, "piece", "body"), *_KEY).sortWithinPartitions(*_KEY, "piece")
            .mapInArrow(_digest, "depth long, k1 long, k2 long, ends_sha256 string"))
    return (near.select(*out).unionByName(far.select(*out)).join(ends, _KEY, "left")
            .withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256))).select(*out[:-2], "ends_sha256"))
