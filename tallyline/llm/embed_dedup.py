"""Near duplicates of embeddings by a forest of random-projection trees.

Each tree splits the vectors again and again by a random direction, at a thinly populated place
near the middle of the projections; vectors close to the cut go to both sides. Vectors that share a
leaf of any tree are compared in double precision, and pairs at or above the cosine threshold are
united. Many trees, each with cuts of its own, leave a close pair apart only if all of them cut it.

The trees of a round are fitted on a bounded sample and small enough to send to the tasks; all
vectors are then filed by them. Leaves that hold more vectors than ``LEAF`` are fitted and split
again, each from a sample of its own, until none is too large. Where vectors have so many near ones
that no leaf could hold them, cuts are chosen by the sampled links that they part; if all cuts would
part too many, the leaf is dense: it stays whole, is dealt into blocks of bounded size, and all
pairs of blocks are compared, each by one group. No pair leaves a task: a leaf counts
each vector's links and gives one link per vector to the smallest vector that it reaches there. A
pair that shares several leaves is counted in the first of them only, which a leaf can tell since
every vector brings the list of all its leaves. Equal vectors are one vector with a count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import dealt, sample_rows, saved
from tallyline.llm.components import components
from tallyline.operators.skew import lookup

TREES = 10
LEAF = 2000          # vectors of a leaf at most, after the last round
SAMPLE = 20_000      # vectors that a round's trees are fitted on
NODE_SAMPLE = 2_000  # of each leaf that is split again
LEAST = 24           # sampled vectors that a node is split by
SPILL = 0.05         # on either side of a cut, for unit vectors
SHARE = 0.03         # of a node that may spill on either side
PROBES = 1024        # sampled vectors of a node whose links are looked at
CUT_LINKS = 0.1      # of the links of vectors with many that one cut may part
KEPT_LINKS = 0.5     # of these links that all cuts on the way to a leaf keep together at least
PEEL = 0.02          # of these links that may be parted to set one group apart
SURE = 200           # sampled vectors that tell that a leaf is dense
DENSE = 1 << 62      # in the id of a leaf that isn't split


def _unit(rows: list, size: int) -> np.ndarray:
    """Unit vectors in double precision; shorter ones are padded by zeros."""
    x = np.zeros((len(rows), size))
    for i, r in enumerate(rows):
        x[i, :len(r)] = r
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class Tree:
    """Splits fitted on a sample: direction, lower and upper edge of the overlap, and two children
    per node; a child below zero is leaf ``-child - 1``. ``dense`` has the leaves above ``leaf``
    vectors that no cut splits without parting too many pairs at or above ``least``."""

    def __init__(self, sample: np.ndarray, share: float, leaf: int, seed: list[int], least: float = 0.9):
        rng = np.random.default_rng(seed)
        self.direction, self.edges, self.children, self.leaves, self.dense, self.least = [], [], [], 0, [], least
        self.root = self._grow(sample, share, leaf, rng, 1.0)

    def _leaf(self, dense: bool = False) -> int:
        if dense:
            self.dense.append(self.leaves)
        self.leaves += 1
        return -self.leaves

    @staticmethod
    def _edges(p: np.ndarray, cut: float) -> tuple[float, float]:
        at = np.searchsorted(p, cut) / len(p)
        return max(cut - SPILL, np.quantile(p, max(0.0, at - SHARE))), min(cut + SPILL, np.quantile(p, min(1.0, at + SHARE)))

    def _grow(self, x: np.ndarray, share: float, leaf: int, rng, kept: float) -> int:
        """share: vectors for each sampled one; kept: of the links in dense places, by the cuts so far."""
        if len(x) * share <= leaf or len(x) < LEAST:
            return self._leaf()
        probes = x[np.linspace(0, len(x) - 1, min(len(x), PROBES)).astype(int)]
        links = probes @ probes.T >= self.least
        np.fill_diagonal(links, False)
        degree = links.sum(1)
        many = degree * (len(x) / len(probes) * share) >= leaf / 4
        links = (links & (many[:, None] | many)).astype(np.float32)
        total = links.sum() / 2

        def parted(r: np.ndarray, low: float, high: float) -> float:
            q = probes @ r
            left, right = q < low, q >= high
            return float(left @ links @ right) / total if left.any() and right.any() else 1.0

        best = None
        for _ in range(6):
            r = rng.standard_normal(x.shape[1])
            r /= np.linalg.norm(r)
            p = np.sort(x @ r)
            for cut in np.quantile(p, np.linspace(0.35, 0.65, 13)):
                low, high = np.searchsorted(p, (cut - SPILL, cut + SPILL))
                loss = parted(r, *self._edges(p, cut)) if total else 0.0
                if best is None or (loss, high - low) < best[:2]:
                    best = loss, high - low, r, cut, p
        if total and (best[0] > CUT_LINKS or kept * (1 - best[0]) < KEPT_LINKS):
            # Set the group around the vector with the most links apart, if it stands by itself.
            best = None
            r = probes[links[np.argmax(degree)] > 0].mean(0)
            r /= np.linalg.norm(r)
            p = np.sort(x @ r)
            for cut in np.linspace(p[0], p[-1], 41)[1:-1]:
                edges = self._edges(p, cut)
                loss = parted(r, *edges)
                low, high = np.searchsorted(p, edges)
                if loss <= PEEL and kept * (1 - loss) >= KEPT_LINKS and min(low, len(p) - high) * share >= leaf / 4:
                    low, high = np.searchsorted(p, (cut - SPILL, cut + SPILL))
                    if best is None or (loss, high - low) < best[:2]:
                        best = loss, high - low, r, cut, p
            if best is None:  # a small sample leaves it to the next round
                return self._leaf(share <= 1 or len(x) >= SURE)
        loss, _, r, cut, p = best
        kept *= 1 - loss
        low, high = self._edges(p, cut)
        me = len(self.children)
        self.direction.append(r)
        self.edges.append((low, high))
        self.children.append(None)
        q = x @ r
        left, right = x[q < high], x[q >= low]
        if len(left) == len(x) or len(right) == len(x):  # nothing tells these apart
            low = high = np.median(q)
            self.edges[me] = (low, high)
            half = np.argsort(q, kind="stable")
            left, right = x[half[:len(x) // 2]], x[half[len(x) // 2:]]
        self.children[me] = (self._grow(left, share, leaf, rng, kept), self._grow(right, share, leaf, rng, kept))
        return me

    def file(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and the leaf of each, with DENSE if it is; a row may be in several."""
        rows, leaves, todo = [], [], [(self.root, np.arange(len(x)))]
        while todo:
            node, at = todo.pop()
            if not len(at):
                continue
            if node < 0:
                rows.append(at)
                leaves.append(np.full(len(at), -node - 1 | (DENSE if -node - 1 in self.dense else 0), np.int64))
                continue
            p, (low, high), (left, right) = x[at] @ self.direction[node], self.edges[node], self.children[node]
            todo += [(left, at[p < high]), (right, at[p >= low])]
        if not rows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(rows), np.concatenate(leaves)


def _file_all(sent):
    """Leaves of vectors that are in no leaf yet: ids of leaves are (tree << 48) + leaf."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, size = sent.value
        for batch in batches:
            x = _unit(batch.column(1).to_pylist(), size)
            rows, leaves = [], []
            for t, tree in enumerate(trees):
                r, leaf = tree.file(x)
                rows.append(r)
                leaves.append((t << 48) + leaf)
            r, leaf = np.concatenate(rows), np.concatenate(leaves)
            order = np.lexsort((leaf, r))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(r[order])), pa.array(leaf[order])],
                                             names=["vec", "leaf"])
    return run


def _split_leaf(size: int, deeper: int, full: int, seed: int, least: float):
    """One leaf's sampled vectors -> the tree that splits it, pickled, under the leaf's id."""
    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        import pickle
        x = _unit(group["embedding"].tolist(), size)
        tree = Tree(x, float(group["n"].iloc[0]) / len(x), full, [seed, key[0] & 0xFFFFFFFF, key[0] >> 32, deeper], least)
        return pd.DataFrame({"leaf": [key[0]], "tree": [pickle.dumps(tree)]})
    return run


def _file_again(size: int, deeper: int):
    """Rows (vec, embedding, leaf, tree), sorted by leaf -> rows in the leaves of the leaf's tree."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pickle
        for batch in batches:
            leaf = batch.column(2).to_numpy()
            edge = np.concatenate([[0], np.flatnonzero(np.diff(leaf)) + 1, [len(leaf)]])
            for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
                if a == b:
                    continue
                tree = pickle.loads(batch.column(3)[a].as_py())
                r, low = tree.file(_unit(batch.column(1).slice(a, b - a).to_pylist(), size))
                # A deeper leaf keeps its tree in the upper bits; the rest is a digest of its way down.
                way = (int(leaf[a]) * 0x9E3779B97F4A7C15 + deeper) & ((1 << 64) - 1)
                dense, low = low & DENSE, low & ~DENSE
                new = dense | (int(leaf[a]) >> 48 << 48) | (1 << 47) | (((np.uint64(way) ^ (low.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
                                                                >> np.uint64(17)).astype(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a).take(pa.array(r)), pa.array(new)],
                                                 names=["vec", "leaf"])
    return run


def _compare(size: int, least: float):
    """Links of one leaf or, if it is dense, of two of its blocks or inside one."""
    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        if len(group) < 2:
            return pd.DataFrame({"vec": [], "links": [], "root": []}).astype("int64")
        group = group.sort_values("vec")
        vec, weight = group["vec"].to_numpy(), group["copies"].to_numpy()
        x = _unit(group["embedding"].tolist(), size)
        linked = np.zeros((len(x), len(x)), bool)
        for i in range(0, len(x), 512):
            linked[i:i + 512] = x[i:i + 512] @ x.T >= least
        linked |= linked.T
        np.fill_diagonal(linked, False)
        if key[1] != key[2]:  # links inside a block are the block's own
            block = group["block"].to_numpy()
            linked &= block[:, None] != block
        a, b = np.nonzero(linked)
        root = np.arange(len(x))
        while len(a):
            low = root.copy()
            np.minimum.at(low, a, root[b])
            low = low[low]
            if (low == root).all():
                break
            root = low
        earlier: dict[int, list[int]] = {}
        for i in np.unique(a).tolist():
            for other in group["leaves"].iloc[i]:
                if other < key[0]:
                    earlier.setdefault(int(other), []).append(i)
        for members in earlier.values():  # pairs that an earlier leaf has counted
            if len(members) > 1:
                linked[np.ix_(members, members)] = False
        held = np.flatnonzero(np.bincount(a, minlength=len(x)))
        return pd.DataFrame({"vec": vec[held], "links": linked[held] @ weight, "root": vec[root[held]]})
    return run


def _blocks(members: DataFrame, leaf: int) -> DataFrame:
    """The members of every leaf by the groups to compare: (a, b), the blocks of a pair, and the own
    ``block``. A leaf that isn't dense is one block; a dense one has blocks of half a leaf's vectors,
    and each row goes to all pairs of its block. A dense leaf whose vectors share an earlier dense
    leaf has nothing to add and is left out."""
    dense = members.where(F.col("leaf") >= DENSE)
    first = F.array_min(F.filter("leaves", lambda x: x >= DENSE))
    sizes = (dense.groupBy("leaf").agg(F.count("*").alias("n"), F.min(first).alias("low"), F.max(first).alias("high"))
             .where("low <> high OR low = leaf").select("leaf", F.ceil(F.col("n") / max(1, leaf // 2)).alias("blocks")))
    dealt_out = (dense.join(sizes, "leaf").withColumn("block", F.pmod(F.xxhash64("vec"), "blocks"))
                 .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
                 .withColumn("a", F.least("block", "other")).withColumn("b", F.greatest("block", "other")).drop("blocks", "other"))
    zero = F.lit(0).cast("long")
    whole = members.where(F.col("leaf") < DENSE).select("*", zero.alias("block"), zero.alias("a"), zero.alias("b"))
    return whole.unionByName(dealt_out)


def _leaves(vectors: DataFrame, size: int, trees: int, leaf: int, seed: int, least: float) -> DataFrame:
    """(vec, leaf) of every vector in every tree, no leaf above ``leaf`` vectors unless it is dense."""
    total = vectors.count()
    sample = _unit([r[0] for r in sample_rows(vectors.select("embedding", "vec"), SAMPLE, total).select("embedding").collect()], size)
    grown = [Tree(sample, total / max(1, len(sample)), leaf * 2 // 3, [seed, t], least) for t in range(trees)]
    sent = vectors.sparkSession.sparkContext.broadcast((grown, size))
    filed = saved(vectors.select("vec", "embedding").mapInArrow(_file_all(sent), "vec long, leaf long"), "leaves")
    for deeper in range(1, 64):
        full = filed.groupBy("leaf").agg(F.count("*").alias("n")).where((F.col("n") > leaf) & (F.col("leaf") < DENSE))
        if full.isEmpty():
            break
        inside = lookup(filed, full, "leaf").where("n IS NOT NULL")
        sampled = (inside.where(F.pmod(F.xxhash64("vec", "leaf", F.lit(deeper)), F.col("n")) < NODE_SAMPLE)
                   .join(vectors.select("vec", "embedding"), "vec"))
        fitted = saved(sampled.groupBy("leaf").applyInPandas(_split_leaf(size, deeper, leaf * 2 // 3, seed, least), "leaf long, tree binary"),
                       "splits")
        again = (inside.select("vec", "leaf").join(fitted, "leaf").join(vectors.select("vec", "embedding"), "vec")
                 .select("vec", "embedding", "leaf", "tree").sortWithinPartitions("leaf")
                 .mapInArrow(_file_again(size, deeper), "vec long, leaf long"))
        filed = saved(filed.join(full, "leaf", "left_anti").select("vec", "leaf").unionByName(again), "leaves")
    return filed


def near_duplicates(table: DataFrame, least: float = 0.9, trees: int = TREES, leaf: int = LEAF, seed: int = 7,
                    id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per input row: ``vec_id``, ``n_links`` (other rows linked directly), ``component_id``
    (the smallest id reachable, the own one included) and ``kept`` (whether that is the own one).

    Rows link if their cosine is ``least`` or more. Vectors that are null, empty or zero, or hold
    null or non-finite components, link with nothing and are kept. Vectors of different lengths are
    compared as if the shorter ended in zeros. Equal vectors link with each other whatever their
    ids; rows that repeat an id are rows of their own. A null id stays null; its component has one
    if any member has, and such a row without links is kept. An empty table gives an empty result.
    Other columns are ignored.
    """
    v = F.col("embedding")
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("embedding"))
    limit = F.lit(float("inf"))
    good = (F.coalesce(F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < limit)), F.lit(False))
            & F.coalesce(F.exists(v, lambda c: c != 0), F.lit(False)))
    bad = rows.where(~good).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                                   F.lit(True).alias("kept"))
    rows = rows.where(good)
    same = rows.groupBy("embedding").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
    # Written once, so that the numbers stay as they are.
    vectors = saved(same.select(F.monotonically_increasing_id().alias("vec"), "first", "embedding", "copies"), "vectors")
    size = vectors.agg(F.max(F.size("embedding"))).first()[0]
    if size is None:
        return bad
    filed = _leaves(vectors, size, trees, leaf, seed, least)
    homes = filed.groupBy("vec").agg(F.sort_array(F.collect_set("leaf")).alias("leaves"))
    members = (vectors.select("vec", "embedding", "copies").join(homes, "vec")
               .withColumn("leaf", F.explode("leaves")))
    groups = _blocks(members, leaf)
    found = saved(dealt(groups, "leaf", "a", "b").groupBy("leaf", "a", "b").applyInPandas(_compare(size, least), "vec long, links long, root long"), "links")
    counts = found.groupBy("vec").agg(F.sum("links").alias("links"))
    stars = components(found.where("vec != root").select("vec", "root"), "vec", "root").withColumnRenamed("node", "vec")
    rooted = (vectors.join(counts, "vec", "left").join(stars, "vec", "left")
              .select("vec", "first", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "vec").alias("root"),
                      "embedding"))
    least_id = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    answer = lookup(rooted, least_id, "root").select(
        "embedding", (F.col("links") + F.col("copies") - 1).alias("n_links"), "component_id")
    out = rows.join(answer, "embedding").select("vec_id", "n_links", "component_id",
                                                F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
    return out.unionByName(bad)
