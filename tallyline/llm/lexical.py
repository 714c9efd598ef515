"""Ranked lexical search turned around: the items are the index, the documents are the queries.

The terms of the items form an inverted index of bounded size that is sent to the tasks. Documents
stream through it: each is reduced once to its length and its counts of item terms, which is written;
document frequencies come from that table. A second stream turns the counts into scores of all items
at once and keeps, per task, a heap of the best documents of each item. Heaps are merged in two steps,
first those of every 64th task, then the rest, so that no group grows with the number of tasks alone.

Items beyond ``BLOCK_BYTES`` of text are searched in several blocks, one after the other; a longer item
is a block by itself.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.llm.common import saved

BEST = 10
BLOCK_BYTES = 4 << 20   # text of the items that are sent to the tasks together
PIECE = 1 << 20         # bytes of a text that are cut into terms at once
CELLS = 1 << 20         # scores, or parts of scores, that are held at once
SALTS = 64
NO_ID = np.iinfo(np.int64).max  # place of a document without an id among equal scores

# Terms are runs of ASCII letters, digits and all other than ASCII; A-Z become a-z.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def term_counts(text: bytes | None, known=None) -> tuple[int, Counter]:
    """The number of terms of a text, and how often it has each of the ``known`` ones (or any)."""
    folded = (text or b"").translate(_FOLD)
    n, counts, start = 0, Counter(), 0
    while start < len(folded):
        end = folded.find(b" ", start + PIECE)
        end = len(folded) if end < 0 else end
        terms = folded[start:end].split()
        n += len(terms)
        counts.update(terms if known is None else filter(known, terms))
        start = end
    return n, counts


class ItemIndex:
    """Terms by number, and for each the items that have it and how often."""

    def __init__(self, texts: list[str]):
        counted = [term_counts(t.encode())[1] for t in texts]
        self.number = {t: k for k, t in enumerate(sorted(set().union(*counted)))} if counted else {}
        term = np.array([self.number[t] for c in counted for t in c], np.int64)
        item = np.repeat(np.arange(len(texts)), [len(c) for c in counted])
        times = np.array([n for c in counted for n in c.values()], np.int64)
        order = np.argsort(term, kind="stable")
        self.item, self.times, self.items = item[order], times[order], len(texts)
        self.begin = np.searchsorted(term[order], np.arange(len(self.number) + 1))
        self.longest = max((sum(c.values()) for c in counted), default=0)


def _count(sent):
    """Documents to (doc_id, n, terms, times); those without any term are no documents here."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = sent.value.number
        for batch in batches:
            ids, ns, terms, times = [], [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                n, counts = term_counts(text.as_py(), number.__contains__)
                if n:
                    ids.append(doc)
                    ns.append(n)
                    terms.append([number[t] for t in counts])
                    times.append(list(counts.values()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), pa.array(terms, pa.list_(pa.int32())),
                 pa.array(times, pa.list_(pa.int64()))], names=["doc_id", "n", "terms", "times"])
    return run


class Heaps:
    """The best documents of each item: highest score, then smallest id."""

    def __init__(self, items: int, best: int):
        self.best, self.heaps = best, [[] for _ in range(items)]
        self.score = np.zeros(items, np.int64)  # what a document must beat, with its place
        self.place = np.full(items, np.iinfo(np.int64).min)

    def add(self, scores: np.ndarray, place: np.ndarray, missing: np.ndarray) -> None:
        """Scores by document and item; the documents' ids, and which have none."""
        better = (scores > self.score) | ((scores == self.score) & (place[:, None] < self.place))
        if len(scores) > self.best:
            better &= scores >= np.partition(scores, -self.best, axis=0)[-self.best]
        row, item = np.nonzero(better)
        order = np.lexsort((place[row], -scores[row, item], item))
        row, item = row[order], item[order]
        first = np.arange(len(item)) - np.searchsorted(item, item) < self.best
        row, item = row[first], item[first]
        for r, i, s in zip(row.tolist(), item.tolist(), scores[row, item].tolist()):
            heap, entry = self.heaps[i], (s, -int(place[r]), not missing[r])
            if len(heap) < self.best:
                heapq.heappush(heap, entry)
            else:
                heapq.heappushpop(heap, entry)
            if len(heap) == self.best:
                self.score[i], self.place[i] = heap[0][0], -heap[0][1]


def _search(sent, weights, documents: int, terms: int, best: int):
    """Counts to the best documents of each item in this task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, weight = sent.value, weights.value
        heaps = Heaps(index.items, best)
        posts = np.diff(index.begin)
        exact = int(weight.max(initial=0)) * 1_000_000 * index.longest < 1 << 53  # sums of doubles are whole numbers then
        for batch in batches:
            doc, n = batch.column(0), batch.column(1).to_numpy()
            missing = doc.is_null().to_numpy(zero_copy_only=False)
            place = doc.fill_null(NO_ID).to_numpy()
            edge = batch.column(2).offsets.to_numpy().astype(np.int64)
            edge -= edge[0]
            term, times = batch.column(2).flatten().to_numpy(), batch.column(3).flatten().to_numpy()
            m = 25 + (75 * n * documents) // terms
            work = np.concatenate([[0], np.cumsum(posts[term])])[edge]  # parts of scores before each document
            at = 0
            while at < len(n):
                end = int(np.searchsorted(work, work[at] + CELLS, "right")) - 1
                end = max(at + 1, min(end, len(n), at + max(1, CELLS // index.items)))
                a, b = edge[at], edge[end]
                row = np.repeat(np.arange(end - at), np.diff(edge[at:end + 1]))
                t, tf = term[a:b], times[a:b]
                part = weight[t] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[at:end][row]))
                k = posts[t]
                post = np.arange(int(k.sum())) + np.repeat(index.begin[t] - (np.cumsum(k) - k), k)
                cell = np.repeat(row * index.items, k) + index.item[post]
                part = np.repeat(part, k) * index.times[post]
                if exact:
                    scores = np.bincount(cell, part, (end - at) * index.items).astype(np.int64)
                else:
                    scores = np.zeros((end - at) * index.items, np.int64)
                    np.add.at(scores, cell, part)
                heaps.add(scores.reshape(end - at, -1), place[at:end], missing[at:end])
                at = end
        salt = TaskContext.get().partitionId() % SALTS
        found = [(i, -p if has else None, s, p) for i, heap in enumerate(heaps.heaps) for s, p, has in heap]
        yield pa.RecordBatch.from_arrays(
            [pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.int64()),
             pa.array([f[2] for f in found], pa.int64()), pa.array([salt] * len(found), pa.int32())],
            names=["item", "doc_id", "score", "salt"])
    return run


def _merge(found: DataFrame, best: int) -> DataFrame:
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    for keys in (["item", "salt"], ["item"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= best)
    return found


def rank_documents(docs: DataFrame, items: DataFrame, best: int = BEST, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``best`` documents (doc_id, text) of each item (item_id,
    text) by the whole-number form of BM25 that the weights below state, equal scores by ascending
    doc_id, documents without one last.

    Every row of ``docs`` with at least one term is a document, so a repeated row counts and is
    listed as often as it is there. Items that share id and text are one item; those that share an
    id only are ranked apart under the same id. Null and empty texts have no terms: such documents
    don't count, such items have no rows. Other columns, whatever their names, are ignored.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    items = items.select("item_id", "text").where("length(text) > 0").distinct()
    size, mark = F.octet_length("text") + 16, F.xxhash64("item_id", "text")
    short = items.where(size <= block_bytes)
    blocks = math.ceil((short.agg(F.sum(size)).first()[0] or 0) / block_bytes)
    parts = [short.where(F.pmod(mark, F.lit(blocks)) == block) for block in range(blocks)]  # about block_bytes each
    parts += [items.where((size > block_bytes) & (mark == r[0])) for r in items.where(size > block_bytes).select(mark).distinct().collect()]
    kind = items.schema["item_id"].dataType
    found = []
    for part in parts:
        mine = part.collect()
        index = ItemIndex([r.text for r in mine])
        if not index.number:
            continue
        sent = spark.sparkContext.broadcast(index)
        counts = saved(texts.mapInArrow(_count(sent), "doc_id long, n long, terms array<int>, times array<long>"), "counts")
        documents, terms = counts.agg(F.count("*"), F.sum("n")).first()
        if not documents:
            break
        df = np.zeros(len(index.number), np.int64)
        for term, n in counts.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # item terms only
            df[term] = n
        # A term's weight: floor(1000 ln((2N + 2) / (2df + 1))) of N documents, df of which have it.
        weights = spark.sparkContext.broadcast(np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * d + 1))) for d in df.tolist()], np.int64))
        top = _merge(counts.mapInArrow(_search(sent, weights, documents, terms, best), "item int, doc_id long, score long, salt int"), best)
        names = spark.createDataFrame([(k, r.item_id) for k, r in enumerate(mine)], T.StructType(
            [T.StructField("item", T.IntegerType()), T.StructField("item_id", kind)]))
        found.append(top.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    if not found:
        return spark.createDataFrame([], T.StructType([
            T.StructField("item_id", kind), T.StructField("rank", T.IntegerType()), T.StructField("doc_id", T.LongType()),
            T.StructField("score", T.LongType())]))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out
