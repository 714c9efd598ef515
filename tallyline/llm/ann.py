"""Approximate nearest neighbours by largest inner product: inverted lists, scanned by adaptive dimensions.

Vectors get one more component that brings all of them to the length of the longest, so that the
largest inner product is the smallest distance. They are filed under the nearest of up to ``LISTS``
centroids, which are fitted on a bounded sample; every vector is filed. A query probes as many lists
as its neighbours in the sample ask for (``WANTED``).

Inside a list, vectors and queries are rotated at random and compared in blocks of columns. Under a
random rotation the part of a squared distance that falls to the first d of D columns is distributed
as Beta(d/2, (D-d)/2), so after each block the hypothesis "this candidate is not farther than the
best known so far" is tested at the level ``LEVEL``, and rejected candidates are abandoned. What
survives all blocks is scored on the original vectors in double precision. The lists next to a query
are scanned first; their results are the bar that candidates of all its other lists must pass.

Lists are packed into cells of bounded size, or cut into several when they are larger; a cell meets
its queries in blocks of bounded size. Equal vectors are one candidate with the smallest ids it may
need, and equal queries are searched once.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.llm.common import sample_rows, saved

NEAREST = 20
LISTS = 2048             # centroids at most
LIST = 100               # vectors of a list, as long as there are fewer lists than that
SAMPLE = 30_000          # vectors that the index is fitted on at most, and
SAMPLE_BYTES = 64 << 20  # their size in double precision
TRIED = 256              # sampled vectors that the number of probed lists is chosen by
WANTED = 0.96            # share of their neighbours in the sample that the probed lists must hold
LEAST = 2000             # vectors that a query is compared with at least
HOME = 8                 # one of so many probed lists is scanned before the bar is set
LEVEL = 1e-4             # of a test
CELL_BYTES = 32 << 20    # vectors of a cell, and queries of a block, in double precision
CELLS_A_TASK = 4         # cells for each task that can run, as long as they are not too small
PAIRS = 1 << 20          # distances that are held at once
THIN = 0.25              # share of candidates left below which they are compared one by one


class Index(NamedTuple):
    centroids: np.ndarray   # with the added component
    probes: int
    longest: float          # squared length
    rotation: np.ndarray
    edges: list[int]        # of the blocks of columns
    shares: np.ndarray      # of a squared distance that the columns up to an edge exceed with LEVEL
    cell: np.ndarray        # first cell of each list
    pieces: np.ndarray      # cells of each list


def _decode(column: pa.Array, dtype: str) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), dtype).reshape(len(rows), -1).astype(np.float64)


def _lift(x: np.ndarray, longest: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(0.0, longest - (x * x).sum(1)))
    return np.concatenate([x, rest[:, None]], axis=1)


def _flat(x: np.ndarray) -> np.ndarray:
    return np.concatenate([x, np.zeros((len(x), 1))], axis=1)


def _order(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances but for the length of x: enough to order the centroids."""
    return (centroids * centroids).sum(1) - 2 * (x @ centroids.T)


def beta_edge(a: float, b: float, level: float) -> float:
    """What a Beta(a, b) variable exceeds with probability ``level``."""
    x = np.linspace(0, 1, 20_001)[1:-1]
    log = (a - 1) * np.log(x) + (b - 1) * np.log1p(-x)
    mass = np.cumsum(np.exp(log - log.max()))
    at = int(np.searchsorted(mass, mass[-1] * (1 - level)))
    return float(x[min(at + 1, len(x) - 1)])


def _fit(sample: np.ndarray, n: int, longest: float, tasks: int, k: int) -> Index:
    """Centroids by k-means, and how many of their lists hold the neighbours of sampled vectors."""
    lists = max(1, min(LISTS, n // LIST, len(sample)))
    x = _lift(sample, longest)
    c = x[:lists].copy()
    at = np.zeros(len(x), np.int64)
    for turn in range(7):
        for s in range(0, len(x), 4096):
            at[s:s + 4096] = _order(x[s:s + 4096], c).argmin(1)
        if turn < 6:
            sums = np.zeros_like(c)
            np.add.at(sums, at, x)
            size = np.bincount(at, minlength=lists)
            c[size > 0] = sums[size > 0] / size[size > 0, None]
    tried = sample[-TRIED:]
    scores = tried @ sample.T
    scores[np.arange(len(tried)), np.arange(len(sample) - len(tried), len(sample))] = -np.inf
    near = np.argsort(-scores, axis=1, kind="stable")[:, :min(k, len(sample) - 1)]
    place = np.argsort(np.argsort(_order(_flat(tried), c), axis=1, kind="stable"), axis=1)
    needed = np.sort(np.take_along_axis(place, at[near], 1).ravel())
    probes = int(needed[math.ceil(WANTED * len(needed)) - 1]) + 1 if len(needed) else 1
    probes = min(lists, max(probes, math.ceil(LEAST * lists / n)))
    size = x.shape[1]
    rotation = np.linalg.qr(np.random.default_rng(12).standard_normal((size, size)))[0]
    step = max(16, math.ceil(size / 16))
    edges = [*range(step, size, step), size]
    shares = np.array([*[beta_edge(d / 2, (size - d) / 2, LEVEL) for d in edges[:-1]], 1.0])
    # Pack lists that lie next to each other along the sample's widest direction into cells.
    centred = c - c.mean(0)
    along = np.argsort(centred @ np.linalg.svd(centred, full_matrices=False)[2][0], kind="stable")
    weight = np.bincount(at, minlength=lists) * (n / len(sample))
    room = min(CELL_BYTES / (8 * size), max(1024.0, n / (CELLS_A_TASK * tasks)))
    cell, pieces, now, held = np.zeros(lists, np.int32), np.ones(lists, np.int32), 0, 0.0
    for one in along.tolist():
        need = max(1, math.ceil(weight[one] / room))
        if held and held + weight[one] > room:
            now, held = now + 1, 0.0
        cell[one], pieces[one] = now, need
        if need > 1:
            now, held = now + need, 0.0
        else:
            held += weight[one]
    return Index(c, probes, longest, rotation, edges, shares, cell, pieces)


def _pack(size: int, dtype: str):
    """(vec_id, key, vector): a key of 128 bits stands for the components."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            edge = lists.offsets.to_numpy()
            values = lists.flatten().to_numpy(zero_copy_only=False).astype(dtype) + np.array(0, dtype)  # no negative zero
            vectors = []
            for a, b in zip((edge[:-1] - edge[0]).tolist(), (edge[1:] - edge[0]).tolist()):
                vectors.append(values[a:b].tobytes().ljust(size * np.dtype(dtype).itemsize, b"\0"))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([hashlib.blake2b(v, digest_size=16).digest() for v in vectors], pa.binary()),
                 pa.array(vectors, pa.binary())], names=["vec_id", "key", "vector"])
    return run


def _lengths(dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _decode(batch.column(0), dtype) if batch.num_rows else np.zeros((0, 1))
            yield pa.RecordBatch.from_arrays([pa.array((x * x).sum(1), pa.float64())], names=["length"])
    return run


def _file(sent, dtype: str):
    """Candidates with their list and cell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _lift(_decode(batch.column("vector"), dtype), index.longest)
            at = _order(x, index.centroids).argmin(1)
            piece = np.array([int.from_bytes(k[:4], "big") for k in batch.column("key").to_pylist()]) % index.pieces[at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(index.cell[at] + piece, pa.int32()), pa.array(at, pa.int32()), *batch.columns], names=["cell", "list", *batch.schema.names])
    return run


def _probe(sent, dtype: str, home: bool):
    """Queries with the lists they probe, once for each cell: the nearest lists or the others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        first = max(1, index.probes // HOME)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _flat(_decode(batch.column("vector"), dtype))
            near = np.argsort(_order(x, index.centroids), axis=1, kind="stable")[:, :index.probes]
            near = near[:, :first] if home else near[:, first:]
            row, lists = np.repeat(np.arange(len(near)), near.shape[1]), near.ravel()
            times = index.pieces[lists]
            piece = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
            row, lists = np.repeat(row, times), np.repeat(lists, times)
            cell = index.cell[lists] + piece
            order = np.lexsort((lists, cell, row))
            row, lists, cell = row[order], lists[order], cell[order]
            new = np.flatnonzero(np.concatenate([[True], (np.diff(row) != 0) | (np.diff(cell) != 0)])) if len(row) else np.zeros(0, np.int64)
            taken = batch.take(pa.array(row[new]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell[new], pa.int32()), pa.ListArray.from_arrays(pa.array(np.append(new, len(row)), pa.int32()), pa.array(lists, pa.int32())),
                 *taken.columns], names=["cell", "lists", *batch.schema.names])
    return run


class Scan:
    """The candidates of a cell against a block of queries."""

    def __init__(self, index: Index, x: np.ndarray, first: np.ndarray, q: np.ndarray, bar: np.ndarray, k: int):
        self.index, self.x, self.first, self.q, self.bar, self.k = index, x, first, q, bar.copy(), k
        self.columns = [(_flat(q) @ index.rotation, _lift(x, index.longest) @ index.rotation)]
        cuts = [0, *index.edges]
        self.columns = [tuple(np.ascontiguousarray(m[:, a:b]) for m in self.columns[0]) for a, b in zip(cuts, cuts[1:])]
        self.squares = [tuple((m * m).sum(1) for m in block) for block in self.columns]
        self.reach = (q * q).sum(1) + index.longest  # of a squared distance: this less twice the inner product
        self.none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        self.found, self.waiting, self.abandoned = [self.none], 0, 0

    def compare(self, qs: np.ndarray, xs: np.ndarray) -> None:
        step = max(1, PAIRS // max(1, len(xs)))
        for s in range(0, len(qs), step):
            self._compare(qs[s:s + step], xs)

    def _compare(self, qs: np.ndarray, xs: np.ndarray) -> None:
        limit = (self.reach - 2 * self.bar)[qs]
        slack = 1e-9 * self.reach[qs]
        total, live, pairs = np.zeros((len(qs), len(xs))), None, None
        for ((qb, xb), (q2, x2), share) in zip(self.columns, self.squares, self.index.shares):
            edge = limit * share + slack
            if pairs is None:
                total += q2[qs][:, None] + x2[xs] - 2 * (qb[qs] @ xb[xs].T)
                live = total <= edge[:, None]
                if live.mean() < THIN:
                    a, b = np.nonzero(live)
                    pairs, total = (a, b), total[a, b]
            else:
                a, b = pairs
                total = total + ((qb[qs[a]] - xb[xs[b]]) ** 2).sum(1)
                kept = total <= edge[a]
                pairs, total = (a[kept], b[kept]), total[kept]
        a, b = np.nonzero(live) if pairs is None else pairs
        self.abandoned += len(qs) * len(xs) - len(a)
        a, b = qs[a], xs[b]
        part = max(1, PAIRS // (2 * self.x.shape[1]))
        for s in range(0, len(a), part):
            i, j = a[s:s + part], b[s:s + part]
            score = (self.q[i] * self.x[j]).sum(1)
            kept = score >= self.bar[i]
            self.found.append((i[kept], j[kept], score[kept]))
            self.waiting += int(kept.sum())
            if self.waiting > max(4 * self.k * len(self.q), PAIRS // 4):
                self.cut()

    def cut(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The best ``k`` of each query so far, which raise its bar."""
        i, j, score = (np.concatenate(p) for p in zip(*self.found))
        order = np.lexsort((self.first[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        last = rank == self.k - 1
        self.bar[i[last]] = np.maximum(self.bar[i[last]], score[last])
        kept = rank < self.k
        self.found, self.waiting = [(i[kept], j[kept], score[kept])], 0
        return self.found[0]


_FOUND = "qkey binary, same boolean, ids array<long>, score double"


def _search(sent, dtype: str, k: int):
    def run(wares: pa.Table, asked: pa.Table) -> pa.Table:
        schema = pa.schema([("qkey", pa.binary()), ("same", pa.bool_()), ("ids", pa.list_(pa.int64())), ("score", pa.float64())])
        if not wares.num_rows or not asked.num_rows:
            return schema.empty_table()
        wares, asked = wares.combine_chunks(), asked.combine_chunks()
        ids = wares.column("ids").combine_chunks()
        first = ids.flatten().to_numpy()[ids.offsets.to_numpy()[:-1] - ids.offsets[0].as_py()]
        bar = asked.column("bar").fill_null(-np.inf).to_numpy()
        scan = Scan(sent.value, _decode(wares.column("vector"), dtype), first, _decode(asked.column("vector"), dtype), bar, k)
        lists = asked.column("lists").combine_chunks()
        owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        probed, of = lists.flatten().to_numpy(), wares.column("list").to_numpy()
        by_list, by_probe = np.argsort(of, kind="stable"), np.argsort(probed, kind="stable")
        for one in np.unique(probed).tolist():
            a, b = np.searchsorted(of[by_list], (one, one + 1))
            c, d = np.searchsorted(probed[by_probe], (one, one + 1))
            if b > a:
                scan.compare(owner[by_probe[c:d]], by_list[a:b])
        i, j, score = scan.cut()
        qkey, key = asked.column("key").take(pa.array(i)), wares.column("key").take(pa.array(j))
        same = [x == y for x, y in zip(qkey.to_pylist(), key.to_pylist())]
        return pa.table([qkey, pa.array(same, pa.bool_()), ids.take(pa.array(j)), pa.array(score)], schema=schema)
    return run


def _usable(embedding: str) -> Column:
    x = F.col(embedding)
    plain = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return x.isNotNull() & F.coalesce(plain, F.lit(False)) & F.coalesce(F.exists(x, lambda v: v != 0), F.lit(False))


def nearest(vectors: DataFrame, asked: Column, k: int = NEAREST) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``vectors`` (vec_id, embedding) that ``asked``
    picks, its ``k`` nearest other rows by inner product, all if there are fewer; equal scores by
    the smaller id. Scores are those of the original vectors in double precision.

    Rows without an id, and vectors that are null, empty, zero or hold a null or non-finite
    component, take no part; shorter vectors are filled with zeros. Rows that share id and vector
    are one row. Vectors that share an id are rows of their own, and each asks for itself. Other
    columns, whatever their names, are ignored.
    """
    spark = vectors.sparkSession
    answer = "query_id long, rank int, vec_id long, score double"
    single = vectors.schema["embedding"].dataType.elementType == T.FloatType()
    kind, dtype = ("float", "<f4") if single else ("double", "<f8")
    rows = (vectors.withColumn("_asked", F.coalesce(asked, F.lit(False)))
            .select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>").alias("embedding"), "_asked")
            .where(F.col("vec_id").isNotNull() & _usable("embedding")))
    size = rows.agg(F.max(F.size("embedding"))).first()[0]
    if size is None:
        return spark.createDataFrame([], answer)
    pack = _pack(size, dtype)
    packed = "vec_id long, key binary, vector binary"
    every = rows.select("vec_id", "embedding").mapInArrow(pack, packed)
    queries = rows.where("_asked").select("vec_id", "embedding").mapInArrow(pack, packed)
    # One candidate per vector, with as many of its smallest ids as a result can hold beside the query.
    place = F.dense_rank().over(Window.partitionBy("key").orderBy("vec_id"))
    wares = saved(every.withColumn("place", place).where(F.col("place") <= k + 1).groupBy("key")
                  .agg(F.array_sort(F.collect_set("vec_id")).alias("ids"), F.first("vector").alias("vector")), "vectors")
    n, longest = wares.select("vector").mapInArrow(_lengths(dtype), "length double").agg(F.count("*"), F.max("length")).first()
    most = max(1, min(SAMPLE, SAMPLE_BYTES // (8 * size)))
    sample = np.stack([np.frombuffer(r[0], dtype).astype(np.float64) for r in sample_rows(wares.select("vector"), most, n).collect()])
    sent = spark.sparkContext.broadcast(_fit(sample, n, longest, spark.sparkContext.defaultParallelism, k))
    filed = saved(wares.mapInArrow(_file(sent, dtype), "cell int, list int, key binary, ids array<long>, vector binary"), "filed")
    distinct = saved(queries.groupBy("key").agg(F.first("vector").alias("vector")), "queries")
    room = max(1, CELL_BYTES // (8 * size))

    def scan(home: bool, bars: DataFrame | None) -> DataFrame:
        probes = distinct.mapInArrow(_probe(sent, dtype, home), "cell int, lists array<int>, key binary, vector binary")
        probes = probes.withColumn("bar", F.lit(None).cast("double")) if bars is None else probes.join(bars, "key", "left")
        probes = saved(probes, "probes")
        blocks = saved(probes.groupBy("cell").agg(F.ceil(F.count("*") / room).cast("int").alias("blocks")), "blocks")
        probes = probes.join(blocks, "cell").withColumn("block", F.expr("cast(pmod(xxhash64(key), blocks) as int)")).drop("blocks")
        met = filed.join(blocks, "cell").withColumn("block", F.expr("explode(sequence(0, blocks - 1))")).drop("blocks")
        found = (met.groupBy("cell", "block").cogroup(probes.groupBy("cell", "block"))
                 .applyInArrow(_search(sent, dtype, k + 1), _FOUND))
        return saved(found, "found")

    best = Window.partitionBy("qkey").orderBy(F.desc("score"), F.element_at("ids", 1))
    near = scan(True, None)
    bars = (near.withColumn("r", F.row_number().over(best)).where(F.col("r") == k + 1)
            .select(F.col("qkey").alias("key"), F.col("score").alias("bar")))
    found = near.unionByName(scan(False, saved(bars, "bars")))
    entries = F.flatten(F.transform("all", lambda c: F.transform(c["ids"], lambda i: F.struct(
        (-c["score"]).alias("order"), i.alias("vec_id"), c["same"].alias("same"), c["score"].alias("score")))))
    answers = (found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1)
               .groupBy(F.col("qkey").alias("key")).agg(F.collect_list(F.struct("score", "ids", "same")).alias("all"))
               .select("key", F.slice(F.array_sort(entries), 1, k + 1).alias("all")))
    others = F.filter("all", lambda e: ~(e["same"] & (e["vec_id"] == F.col("query_id"))))
    return (queries.select(F.col("vec_id").alias("query_id"), "key").distinct().join(saved(answers, "answers"), "key")
            .select("query_id", F.posexplode(F.slice(others, 1, k)).alias("p", "e"))
            .select("query_id", (F.col("p") + 1).cast("int").alias("rank"), "e.vec_id", "e.score"))
