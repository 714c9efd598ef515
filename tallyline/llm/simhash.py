"""Near duplicates by SimHash fingerprints within a small bit distance.

Two 64-bit fingerprints that differ in at most two bits differ in at most two of their eight
bytes, so they share at least six positional bytes: that is the guaranteed minimum of the count
filter. The inverted index has a list for each positional byte. All 2,048 of them are ordered by how
many fingerprints have them, and each fingerprint's eight by that order, rarest first: of six or more
that a pair shares, the first is among the first three of both, the second among the first four, and
so on. So a fingerprint enters the lists of its three rarest bytes only; a list that is longer than
``LIST`` is split by its members' next shared byte in that order, as often as it takes. Where the
number of fingerprints says that the average list would be split, the index begins with intersections
of two or more lists at once.

Within a list the shared positional bytes of every pair are tallied, and only the pairs that reach six
are verified by their bits. A list that five shared bytes leave longer than ``LIST`` is a dense group;
its members emit themselves with each single bit turned. Members of one such key lie within two bits
of each other, any two within two bits share a key, and a key has at most 65 members, so the links
are the same. Exact copies have one fingerprint, which enters the index once.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.common import dealt, free_name, saved, text_key
from tallyline.llm.components import components
from tallyline.operators.skew import lookup

SEED = 42
LIST = 256    # fingerprints of a list that are compared with each other
DEEPEST = 5   # positional bytes that name a list, 11 bits each
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_POSTING = pa.schema([("fp", pa.int64()), ("list", pa.int64()), ("last", pa.int8())])


def _hashes(text: str, size: int) -> list[int]:
    words = text.encode().translate(_LOWER).split()  # splits at bytes 20 and 09 to 0D
    if not words:
        return []
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    joined, ends, at = b" ".join(words), [], 0
    for w in words:
        at += len(w)
        ends.append(at)
        at += 1
    starts = [0, *[e + 1 for e in ends]]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(starts, ends[size - 1:])]


def _fold(hashes: list[int]) -> int:
    if not hashes:
        return 0
    h = np.array(hashes, np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 16):
        part = h[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h), bitorder="little").tobytes(), "little", signed=True)


def fingerprint(text: str | None, size: int = 3) -> int:
    """The signed 64-bit SimHash of a text's shingles; a bit is set if more than half of the hashes
    have it. A text without words, or none, has zero."""
    return _fold(_hashes(text, size)) if text else 0


def _fingerprints(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), size) for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.int64())],
                                             names=[*batch.schema.names[:-1], "fp"])
    return run


def _by_rarity(fps: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Places in the order of rarity of each fingerprint's eight positional bytes, rarest first."""
    held = fps.view(np.uint8).reshape(-1, 8).astype(np.int64) + 256 * np.arange(8)
    return np.sort(order[held], axis=1)


def _postings(order: np.ndarray, depth: int, most: int):
    """The lists of each fingerprint that ``depth`` shared bytes name."""
    picks = np.array(list(combinations(range(depth + most), depth)), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy()
            tokens = _by_rarity(fps, order)
            name = np.zeros((len(fps), len(picks)), np.int64)
            for k in range(depth):
                name = name << 11 | tokens[:, picks[:, k]]
            last = np.tile(picks[:, -1].astype(np.int8), len(fps))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(fps, len(picks))), pa.array(name.ravel()), pa.array(last)], schema=_POSTING)
    return run


def _split(order: np.ndarray, depth: int, most: int):
    """From lists that ``depth`` bytes name to those with one more of the bytes behind their last."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, name, last = (batch.column(c).to_numpy() for c in ("fp", "list", "last"))
            tokens = _by_rarity(fps, order)
            for k in range(1, depth + most + 1):
                on = last < k
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fps[on]), pa.array(name[on] << 11 | tokens[on, k]),
                     pa.array(np.full(on.sum(), k, np.int8))], schema=_POSTING)
    return run


def tally(lists: np.ndarray, fps: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows (left, right) of the same list whose fingerprints share ``least`` positional bytes or
    more. Rows are ordered by list; pairs come by how far apart they stand."""
    left, apart = np.arange(len(fps)), 1
    while True:
        left = left[left + apart < len(fps)]
        left = left[lists[left] == lists[left + apart]]
        if not len(left):
            return
        other = fps[left] ^ fps[left + apart]
        shared = (other.view(np.uint8).reshape(-1, 8) == 0).sum(1)
        kept = left[shared >= least]
        yield kept, kept + apart
        apart += 1


def _linked(lists: np.ndarray, fps: np.ndarray, most: int) -> pa.RecordBatch:
    """Each fingerprint with the first of its list that links of the list reach."""
    ends: list[list[np.ndarray]] = [[], []]
    for a, b in tally(lists, fps, 8 - most):
        near = np.bitwise_count((fps[a] ^ fps[b]).view(np.uint64)) <= most
        ends[0].append(a[near])
        ends[1].append(b[near])
    a, b = (np.concatenate(e) if e else np.zeros(0, np.int64) for e in ends)
    root = np.arange(len(fps))
    while True:
        low = root.copy()
        np.minimum.at(low, b, root[a])
        np.minimum.at(low, a, root[b])
        low = low[low]
        if (low == root).all():
            break
        root = low
    held = root != np.arange(len(fps))
    return pa.RecordBatch.from_arrays([pa.array(fps[held]), pa.array(fps[root[held]])], names=["a", "b"])


def _verified(most: int):
    """Over rows (list, fp) ordered by list; a list that goes on in the next batch waits for it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = fps = np.zeros(0, np.int64)
        for batch in batches:
            lists = np.concatenate([lists, batch.column(0).to_numpy()])
            fps = np.concatenate([fps, batch.column(1).to_numpy()])
            whole = int(np.searchsorted(lists, lists[-1])) if len(lists) else 0
            yield _linked(lists[:whole], fps[:whole], most)
            lists, fps = lists[whole:], fps[whole:]
        yield _linked(lists, fps, most)
    return run


def _rarity(prints: DataFrame) -> np.ndarray:
    """For position * 256 + byte, the place of that positional byte among all by number of fingerprints."""
    held = F.array(*[F.shiftrightunsigned("fp", 8 * i).bitwiseAND(255) + 256 * i for i in range(8)])
    number = np.zeros(2048, np.int64)
    for row in prints.select(F.explode(held).alias("byte")).groupBy("byte").count().collect():  # 2,048 at most
        number[row["byte"]] = row["count"]
    order = np.empty(2048, np.int64)
    order[np.argsort(number, kind="stable")] = np.arange(2048)
    return order


def _links(prints: DataFrame, most: int) -> DataFrame:
    """Links between distinct fingerprints: enough of them to connect all that are linked."""
    order, total, depth = _rarity(prints), prints.count(), 1
    while depth < DEEPEST and total * comb(depth + most, depth) > LIST * comb(8, depth) * 256 ** depth:
        depth += 1
    schema = "fp long, list long, last byte"
    index = prints.select("fp").mapInArrow(_postings(order, depth, most), schema)
    links = prints.sparkSession.createDataFrame([], "a long, b long")
    while True:
        sizes = index.groupBy("list").agg(F.count("*").alias("size")).where("size > 1")
        index = saved(lookup(index, sizes, "list").where("size IS NOT NULL"), "simhash-index")
        short = dealt(index.where(F.col("size") <= LIST).select("list", "fp"), "list").sortWithinPartitions("list")
        links = links.unionByName(short.mapInArrow(_verified(most), "a long, b long"))
        long = index.where(F.col("size") > LIST)
        if long.isEmpty():
            return links
        if depth == DEEPEST:
            break
        index = long.select("fp", "list", "last").mapInArrow(_split(order, depth, most), schema)
        depth += 1
    bits = F.array(F.lit(0).cast("long"), *[F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(64)])
    turned = (long.select("fp").distinct().select("fp", F.explode(bits).alias("bit"))
              .select("fp", F.col("fp").bitwiseXOR(F.col("bit")).alias("key")))
    dense = (turned.groupBy("key").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
             .select(F.explode("fps").alias("a"), F.array_min("fps").alias("b")))
    return links.unionByName(dense)


def _grouped(docs: DataFrame, size: int, most: int) -> DataFrame:
    """doc_id, key (hash of the text), fp, root (of the group) and component_id of every row."""
    if not 0 <= most <= 2:
        raise ValueError("the index is exact for at most two bits")
    marked = saved(docs.select("doc_id", text_key().alias("key"), "text")
                   .mapInArrow(_fingerprints(size), "doc_id long, key long, fp long"), "fingerprints")
    first = saved(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    stars = components(_links(first.select("fp"), most))
    rooted = first.join(stars.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return marked.join(lookup(rooted, least, "root").select("fp", "root", "component_id"), "fp")


def near_duplicates(docs: DataFrame, size: int = 3, most: int = 2, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per input row: the id, ``fingerprint`` (16 hex digits) and ``component_id``, the
    smallest id that can be reached over fingerprints at most ``most`` (0 to 2) bits apart.

    Texts are cut at ASCII white space after lower-casing A-Z; shingles have ``size`` words and
    repeats count. Fewer words give one shingle; no words, an empty or a null text give zero,
    which links as any other fingerprint does. Rows that repeat an id each give a row. A null id
    stays null and is never a component's id unless no member has one. An empty table gives an
    empty result. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return _grouped(rows, size, most).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, size: int = 3, most: int = 2) -> DataFrame:
    """The documents with one of each group: the one with the smallest ``doc_id``, a row without id
    only if no other has one. Of rows that repeat that id, the one with the smallest text hash
    stays, once. Columns are as given."""
    found = _grouped(docs.select("doc_id", "text"), size, most)
    keep = (found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("k"))
            .select(F.col("k.doc_id").alias("keep_id"), F.col("k.key").alias("keep_key")))
    key, place = free_name(docs, "text_key"), free_name(docs, "place")
    kept = docs.withColumn(key, text_key()).join(
        keep, F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col(key) == F.col("keep_key")), "left_semi")
    window = Window.partitionBy("doc_id", key).orderBy(key)
    return kept.withColumn(place, F.row_number().over(window)).where(F.col(place) == 1).drop(key, place)
