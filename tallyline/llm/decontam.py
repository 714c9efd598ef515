"""Benchmark decontamination by suffix arrays over the training text.

Every task builds suffix arrays over shards of its documents and looks every suffix of the
benchmark items up in them, by binary search one word deeper at a time. The interval that is left
after a window's words holds every place where the window occurs; places that follow each other
on both sides join to the longest verbatim matches, with their location in item and document.

Only words that some item has can be part of a match. Other words become separators, runs of item
words too short for any window are left out, and the suffix array covers what remains, so it is a
small part of a shard. Documents are read once, in place; nothing is shuffled. The items travel to
the tasks in blocks of bounded size, one block after the other, so a large benchmark takes more
passes and not more memory.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import free_name, saved

WINDOW = 10
BLOCK_BYTES = 16 << 20
SHARD_BYTES = 8 << 20
# Bytes of words are digits, letters (lower-cased) and all of other code points than ASCII.
_WORDS = bytes(b if b in range(0x30, 0x3A) or b in range(0x61, 0x7B) or b > 0x7F
               else b + 32 if b in range(0x41, 0x5B) else 0x20 for b in range(256))
_MATCH = pa.struct([("item_id", pa.string()), ("item_start", pa.int32()), ("doc_start", pa.int32()), ("n_words", pa.int32())])
_MATCH_DDL = "array<struct<item_id:string,item_start:int,doc_start:int,n_words:int>>"


def words_of(text: str | None) -> list[bytes]:
    """The words of a text in UTF-8, A-Z lower-cased."""
    return text.encode().translate(_WORDS).split() if text else []


class Items:
    """A block of benchmark items: numbered words, and all suffixes that begin a window."""

    def __init__(self, items: list[tuple[str | None, str]], window: int):
        self.window, self.number = window, {}
        self.ids: list[str | None] = []
        texts = []
        for item_id, text in items:
            found = words_of(text)
            if found:
                self.ids.append(item_id)
                texts.append([self.number.setdefault(w, len(self.number) + 1) for w in found])
        size = np.array([len(t) for t in texts], np.int64)
        self.words = np.array([w for t in texts for w in t], np.int64)
        self.depth = np.minimum(size, window)
        n = size - self.depth + 1
        start = np.cumsum(size) - size
        self.item = np.repeat(np.arange(len(texts)), n)
        self.offset = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        self.place = self.offset + np.repeat(start, n)
        self.least = int(self.depth.min()) if len(texts) else window


def suffix_array(words: np.ndarray, depth: int) -> np.ndarray:
    """Places in the order of the suffixes that begin there, told apart to ``depth`` words or
    more, by doubling. A suffix that ends is before one that goes on."""
    rank = np.unique(words, return_inverse=True)[1].astype(np.int64) + 1
    step = 1
    while step < depth and rank.max(initial=0) < len(rank):
        key = rank * (len(rank) + 2)
        key[:-step] += rank[step:]
        rank = np.unique(key, return_inverse=True)[1].astype(np.int64) + 1
        step *= 2
    return np.argsort(rank, kind="stable")


def _edge(words: np.ndarray, order: np.ndarray, low, high, value, deep: int, right: bool) -> np.ndarray:
    """In each interval of the suffix array, the first place whose word ``deep`` words in is not
    below the value, or with ``right`` is above it."""
    low, high = low.copy(), high.copy()
    padded = len(words)
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        mid = (low[open_] + high[open_]) // 2
        at = order[mid] + deep
        w = np.where(at < padded, words[np.minimum(at, padded - 1)], -1)
        up = w <= value[open_] if right else w < value[open_]
        low[open_[up]] = mid[up] + 1
        high[open_[~up]] = mid[~up]


def occurrences(words: np.ndarray, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of windows in numbered words, where 0 stands between documents and for words that no
    item has: the first item suffix with that window, and the place; then for every item suffix the
    first of its item that begins with the same window, or -1 if it has no place.

    A window that an item repeats is expanded once, so that an item has at most one hit a place.
    """
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.full(len(items.item), -1, np.int64)
    if not len(items.item):
        return none
    inside = np.concatenate([[0], (words > 0).astype(np.int8), [0]])
    turn = np.diff(inside)
    start, end = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
    long = end - start >= items.least
    start, end = start[long], end[long]
    if not len(start):
        return none
    size = end - start + 1  # each run is followed by one separator
    stop = np.cumsum(size)
    place = np.arange(stop[-1]) + np.repeat(start - (stop - size), size)
    text = np.append(words, 0)[np.minimum(place, len(words))]
    text[stop - 1] = 0
    order = suffix_array(text, items.window)
    low, high = np.zeros(len(items.item), np.int64), np.full(len(items.item), len(order), np.int64)
    depth = items.depth[items.item]
    for deep in range(items.window):
        live = np.flatnonzero((low < high) & (depth > deep))
        if not len(live):
            break
        value = items.words[items.place[live] + deep]
        first = _edge(text, order, low[live], high[live], value, deep, False)
        high[live] = _edge(text, order, first, high[live], value, deep, True)
        low[live] = first
    met = np.flatnonzero(high > low)
    _, first, again = np.unique(items.item[met] * (len(order) + 1) + low[met], return_index=True, return_inverse=True)
    like = none[2]
    like[met] = met[first[again]]
    once = met[np.sort(first)]
    n = (high - low)[once]
    hit = order[np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low[once], n)]
    return np.repeat(once, n), place[hit], like


def _matches(docs: list[list[bytes]], items: Items) -> list[list[dict] | None]:
    get = items.number.get
    size = np.array([len(d) + 1 for d in docs], np.int64)
    begin = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.int64)
    for d, b in zip(docs, begin.tolist()):
        words[b:b + len(d)] = [get(w, 0) for w in d]
    suffix, place, like = occurrences(words, items)
    out: list[list[dict] | None] = [None] * len(docs)
    if not len(suffix):
        return out
    # Windows that follow each other in the item and in the text are one verbatim match. Of a window
    # that the item repeats, a match goes on with the one that follows, and starts with the first.
    order = np.lexsort((place, items.item[suffix]))
    found, at, end = [], -2, -1  # first suffix and place, and number of windows; the last place and suffix of a match
    for s, p in zip(suffix[order].tolist(), place[order].tolist()):
        if p == at + 1 and end + 1 < len(like) and like[end + 1] == s:
            found[-1][2] += 1
            end += 1
        else:
            found.append([s, p, 1])
            end = s
        at = p
    first, start, windows = np.array(found, np.int64).T
    doc = np.searchsorted(begin, start, side="right") - 1
    item, n = items.item[first], windows - 1 + items.depth[items.item[first]]
    for d, i, o, p, k in zip(doc.tolist(), item.tolist(), items.offset[first].tolist(), (start - begin[doc]).tolist(), n.tolist()):
        if out[d] is None:
            out[d] = []
        out[d].append({"item_id": items.ids[i], "item_start": o, "doc_start": p, "n_words": k})
    return out


def _search(sent, window: int, text: int, n_words: int, found: int, drop_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(sent.value, window)

        def done(part: pa.RecordBatch, docs: list[list[bytes]]) -> pa.RecordBatch:
            new = _matches(docs, items)
            old = part.column(found).to_pylist()
            columns = list(part.columns)
            columns[n_words] = pa.array([len(d) for d in docs], pa.int64())
            columns[found] = pa.array([(a or []) + (b or []) for a, b in zip(old, new)], pa.list_(_MATCH))
            names = list(part.schema.names)
            if drop_text:
                del columns[text], names[text]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            start = size = 0
            docs: list[list[bytes]] = []
            for i, value in enumerate(batch.column(text)):
                value = value.as_py()
                if docs and size + len(value or "") > SHARD_BYTES:
                    yield done(batch.slice(start, i - start), docs)
                    start, size, docs = i, 0, []
                docs.append(words_of(value))
                size += len(value or "")
            if docs:
                yield done(batch.slice(start), docs)
    return run


def find_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text",
                 keep_text: bool = True, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows and columns given (without the text if ``keep_text`` is false), ``n_words``, and
    ``matches``: the longest verbatim matches of at least ``window`` words, or of a whole shorter
    item, each with ``item_id`` (as text), its first word in item and document, and ``n_words``.

    A null or empty text has no words and no matches, and neither matches a null or empty item. An
    item that is repeated, or that repeats itself, matches at every place. Items without an id match
    with a null ``item_id``. Columns of those names that the documents bring are replaced; others,
    those of the benchmark too, are ignored or carried along.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("id"), "text").where("length(text) > 0")
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    current = docs.drop("n_words", "matches").withColumns(
        {"n_words": F.lit(0).cast("long"), "matches": F.lit(None).cast(_MATCH_DDL)})
    for block in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block)  # about block_bytes
        sent = spark.sparkContext.broadcast([(r[0], r[1]) for r in mine.collect()])
        drop = block == blocks - 1 and not keep_text
        fields = [f for f in current.schema.fields if not (drop and f.name == text_col)]
        at = [current.columns.index(c) for c in (text_col, "n_words", "matches")]
        current = current.mapInArrow(_search(sent, window, *at, drop), ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}" for f in fields))
        if block < blocks - 1:
            current = saved(current, "matches")
    return current


def summary(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``doc_id`` and ``text``: words, words inside windows of items, and the items."""
    found = find_matches(docs.select("doc_id", "text"), benchmark, window, keep_text=False)
    spans = F.array_sort(F.transform("matches", lambda m: F.struct(m["doc_start"].alias("a"), (m["doc_start"] + m["n_words"]).alias("b"))))
    hit = F.aggregate(spans, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), lambda x, m: F.struct(  # the union of the spans
        (x["n"] + F.greatest(F.lit(0), m["b"] - F.greatest(m["a"], x["end"]))).alias("n"), F.greatest(x["end"], m["b"]).alias("end")))["n"]
    items = F.array_sort(F.array_distinct(F.filter(F.transform("matches", lambda m: m["item_id"]), lambda i: i.isNotNull())))
    found = found.select("doc_id", "n_words", hit.cast("long").alias("n_hit"), items.alias("items"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without any match, with the columns given."""
    words, matches = free_name(docs, "n_words"), free_name(docs, "matches")
    if (words, matches) != ("n_words", "matches"):  # the documents' own columns of these names stay
        own = {c: f"{c}__own" for c in docs.columns if c.lower() in ("n_words", "matches")}
        kept = remove_contaminated(docs.withColumnsRenamed(own), benchmark, window)
        return kept.withColumnsRenamed({v: k for k, v in own.items()})
    return find_matches(docs, benchmark, window).where(F.size("matches") == 0).drop("n_words", "matches")
