"""Passages of several lines that stand in the corpus more than once, found by chunks that only content defines.

Every line that isn't blank and the next such line make a chunk, with the blank lines between them,
whatever stands before and after. A passage of any length that is repeated anywhere is the union of
such pairs, so it is found as a whole. Blank lines at the edges of a passage go by larger chunks: a
rolling hash over the hashes of neighbouring lines decides where one ends and the next begins, a few
times with independent hashes; of these only the ones that begin or end in a blank line add anything
to the pairs. Chunks are counted over the whole corpus by hash, chunks that occur once are
forgotten, and the texts of the others are brought together by hash: only if all bytes agree are all
occurrences but the first removed.

What is shuffled: a hash and a place for each chunk, the documents once to fetch the bytes of
repeated chunks, and once to remove lines. Counts and comparisons are aggregations that combine
before the shuffle, so a passage that a third of the documents share is no burden for one task; the
join of occurrences to counts is split by adaptive execution.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import free_name, saved, text_key

PASSES = 6
DIVISOR = 4       # a line begins a chunk, or ends one, once in so many
LONG_LINE = 50    # words above which a line is a passage by itself
_MASK = (1 << 64) - 1
_CHUNK = pa.schema([("hash", pa.int64()), ("doc_id", pa.int64()), ("key", pa.int64()), ("start", pa.int32()), ("n", pa.int32())])


def _cuts(hashes: np.ndarray, seed: int) -> np.ndarray:
    """Whether a boundary stands before each line. The rolling hash covers two lines at a time; the
    two lines that follow a place may say that a chunk begins there, the two before it that one ends."""
    after = np.append(hashes[1:], np.uint64(0))
    rolled = hashes * np.uint64(0x100000001B3) + after  # of each line and the next
    mix = np.uint64(0x9E3779B97F4A7C15 * (2 * seed + 1) & _MASK)
    begins = (rolled ^ np.uint64(~seed & _MASK)) * mix
    ends = (rolled ^ np.uint64(seed)) * mix
    out = (begins >> np.uint64(33)) % np.uint64(DIVISOR) == 0
    out[2:] |= (ends[:-2] >> np.uint64(33)) % np.uint64(DIVISOR) == 1
    out[0] = True
    return out


def _pairs(lines: list[str], hashes: np.ndarray, filled: np.ndarray) -> Iterator[tuple[int, int]]:
    """Each line that isn't blank with the next such line. In a run of equal pairs the second overlaps
    the first, which may have to stay; there the three lines together make the chunk."""
    at = np.flatnonzero(filled).tolist()
    of = hashes[filled].tolist()
    same = False  # whether the pair before equals the one before it
    for k in range(len(at) - 1):
        start, end = at[k], at[k + 1] + 1
        before, same = same, (k > 0 and of[k - 1] == of[k] == of[k + 1] and lines[at[k - 1]:start + 1] == lines[start:end])
        if same and not before:
            start = at[k - 1]
        yield start, end - start


def chunks(text: str, passes: int = PASSES, long_line: int = LONG_LINE) -> list[tuple[int, int]]:
    """First line and number of lines of every chunk that can count as a passage: two or more lines
    that aren't blank, or one of more than ``long_line`` words, which is always a chunk."""
    lines = text.split("\n")
    hashes = np.fromiter((xxhash.xxh64_intdigest(x.encode()) for x in lines), np.uint64, len(lines))
    filled = np.fromiter((bool(x.strip()) for x in lines), bool, len(lines))
    long = np.fromiter((x.count(" ") >= long_line and len(x.split()) > long_line for x in lines), bool, len(lines))
    found = {(i, 1) for i in np.flatnonzero(long).tolist()}
    found.update(_pairs(lines, hashes, filled))
    before = np.concatenate([[0], np.cumsum(filled)])
    for seed in range(passes):
        cut = _cuts(hashes, seed)
        cut |= long
        cut[1:] |= long[:-1]
        start = np.flatnonzero(cut)
        end = np.append(start[1:], len(lines))
        ok = (before[end] - before[start] > 1) & ~(filled[start] & filled[end - 1])  # else it is a union of pairs
        found.update(zip(start[ok].tolist(), (end - start)[ok].tolist()))
    return sorted(found)


def _body(lines: list[str], start: int, n: int) -> bytes:
    return "\n".join(lines[start:start + n]).encode()


def _find(passes: int, long_line: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for doc_id, key, text in zip(*(batch.column(i) for i in range(3))):
                text = text.as_py()
                if not text:
                    continue
                lines = text.split("\n")
                for start, n in chunks(text, passes, long_line):
                    h = xxhash.xxh64_intdigest(_body(lines, start, n))
                    for c, v in zip(out, (h - (1 << 64) if h >> 63 else h, doc_id.as_py(), key.as_py(), start, n)):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, _CHUNK)], schema=_CHUNK)
    return run


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes, bodies, size = [], [], 0
        for text, spans in zip(batch.column(0), batch.column(1)):
            lines = text.as_py().split("\n")
            for s in {x["hash"]: x for x in spans.as_py()}.values():
                hashes.append(s["hash"])
                bodies.append(_body(lines, s["start"], s["n"]))
                size += len(bodies[-1])
                if size > 16 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(bodies)], names=["hash", "body"])
                    hashes, bodies, size = [], [], 0
        yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64()), pa.array(bodies, pa.binary())], names=["hash", "body"])


def _remove(text: int, spans: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, totals, gone = [], [], []
            for value, removed in zip(batch.column(text), batch.column(spans)):
                value, removed = value.as_py(), removed.as_py()
                lines = [] if value is None else value.split("\n")
                totals.append(len(lines))
                drop = {i for s in removed or () for i in range(s["start"], s["start"] + s["n"])}
                gone.append(len(drop))
                texts.append("\n".join([x for i, x in enumerate(lines) if i not in drop]) if drop else value)
            columns, names = list(batch.columns), list(batch.schema.names)
            columns[text] = pa.array(texts, pa.string())
            columns[spans] = pa.array(totals, pa.int64())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(gone, pa.int64())], names=[*names, "gone"])
    return run


def find_repeated(docs: DataFrame, passes: int = PASSES, long_line: int = LONG_LINE) -> DataFrame:
    """Occurrences of repeated passages other than the first: ``doc_id``, ``key`` (hash of the
    text), and ``spans`` of lines (start, n). Needs ``doc_id`` and ``text``."""
    rows = docs.select("doc_id", text_key().alias("key"), "text")
    places = saved(rows.mapInArrow(_find(passes, long_line), "hash long, doc_id long, key long, start int, n int"), "chunks")
    # Rows that share id and text are one document.
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key", "start")
    counted = (places.groupBy("hash").agg(F.min(place).alias("first"), F.max(place).alias("last"))
               .where("first <> last"))
    repeated = saved(places.join(counted.select("hash", "first"), "hash")
                     .select("hash", "doc_id", "key", "start", "n", (F.col("first") == place).alias("is_first")), "repeated-chunks")
    wanted = (repeated.groupBy("doc_id", "key").agg(F.collect_set(F.struct("hash", "start", "n")).alias("spans"))
              .withColumnsRenamed({"doc_id": "id", "key": "id_key"}))
    texts = rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("key") == F.col("id_key"))).select("text", "spans")
    agreed = (texts.mapInArrow(_bodies, "hash long, body binary").groupBy("hash")
              .agg(F.min("body").alias("low"), F.max("body").alias("high")).where("low = high").select("hash"))
    return (repeated.where(~F.col("is_first")).join(agreed, "hash")
            .groupBy("doc_id", "key").agg(F.collect_set(F.struct("start", "n")).alias("spans")))


def dedup_lines(docs: DataFrame, passes: int = PASSES, long_line: int = LONG_LINE, report: bool = False) -> DataFrame:
    """The rows and columns given, with ``text`` freed of every repeated passage but its first
    occurrence in the corpus (by ``doc_id``, then place), and ``n_chars``, if there, counted anew.
    ``report`` adds ``n_lines`` of the text given and ``n_removed``.

    Lines end at \\n and count byte for byte. A passage is two or more lines that aren't blank, with
    the blank lines between them, or a line of more than ``long_line`` words; single shorter lines
    stay however often they occur. A passage goes as a whole if each two neighbouring lines of it
    stood together before, be it in different places. Null and empty texts stay as they are; a
    document that is all repeats ends up empty. Rows that repeat both id and text count as one
    document and are treated alike; an id with other texts, and rows without id, are documents of
    their own. An empty table gives an empty result.
    """
    spans = find_repeated(docs.select("doc_id", "text"), passes, long_line)
    key, found = free_name(docs, "text_hash"), free_name(docs, "spans")
    spans = spans.select(F.col("doc_id").alias("id"), F.col("key").alias("id_key"), F.col("spans").alias(found))
    marked = docs.withColumn(key, text_key()).join(
        spans, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col(key) == F.col("id_key")), "left")
    marked = marked.select(*docs.columns, found)
    lines, gone = (free_name(docs, "n_lines"), free_name(docs, "n_removed"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    cleaned = marked.mapInArrow(_remove(docs.columns.index("text"), len(docs.columns)),
                                f"{schema}, `{lines}` long, `{gone}` long")
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.when(F.col(gone) > 0, F.length("text")).otherwise(F.col("n_chars"))
                                     .cast(docs.schema["n_chars"].dataType))
    return cleaned if report else cleaned.drop(lines, gone)
