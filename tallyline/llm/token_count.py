"""Token counts per document without encoding any document.

A pre-token has the same number of pieces wherever it stands. So the texts are reduced to
pre-token frequencies, every distinct pre-token is encoded once, and a document's count is the sum
of pieces times frequency. No ids of a document are ever made.

The steps and what moves between them:

1. Each task turns its documents into frequencies, a few thousand documents at a time, and packs
   them by bucket of the pre-token: every distinct pre-token of the batch once, with the positions
   of the documents that hold it. This inverted form is what is shuffled, at about two bytes for a
   (document, pre-token) pair.
2. A bucket is all there is of its pre-tokens. Its reader counts the pieces of each once and joins
   the counts to the frequencies as they stream by. A pre-token held by a large share of a batch
   goes to a bucket chosen by batch too, so that no bucket gets all of a word that every document
   has; such a word is then counted once in each bucket.
3. A bucket's sums for a batch are one row: a count for each document, or pairs of document and
   count where few documents have any. Those rows meet by batch and are added up as they stream by.
"""

from __future__ import annotations

import zlib
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyline.llm.pretoken import is_plain, pretokens

BATCH_DOCS = 16_000        # positions of a batch fit 16 bits
BATCH_CHARS = 32 << 20
COMMON = 8                 # a pre-token in more than 1/COMMON of a batch is dealt by batch too
SLICE = 50                 # rows that are handed on together

_PACKED = ("bucket int, base long, texts binary, lens binary, rows binary, at binary, freq binary, "
           "ids array<long>, sizes array<long>")

_TOKENIZERS: dict[int, Tokenizer] = {}


def _tokenizer(definition: str) -> Tokenizer:
    key = hash(definition)
    if key not in _TOKENIZERS:
        _TOKENIZERS[key] = Tokenizer.from_str(definition)
    return _TOKENIZERS[key]


def _pieces_of(texts: list[str], tokenizer: Tokenizer) -> np.ndarray:
    out = np.empty(len(texts), np.int64)
    for i in range(0, len(texts), 4096):
        found = tokenizer.encode_batch(texts[i:i + 4096], add_special_tokens=False)
        out[i:i + len(found)] = [len(e.ids) for e in found]
    return out


def _split(text: str, specials: list[str], tokenizer: Tokenizer) -> Counter:
    """Frequencies of the pre-tokens of a text. Special strings stand for themselves."""
    for s in specials:
        if s in text:
            total = Counter()
            for k, part in enumerate(text.split(s)):
                total.update(_split(part, [x for x in specials if x != s], tokenizer))
                total[s] += k > 0
            return total
    if is_plain(text):
        return Counter(pretokens(text))
    # Letters newer than this Python's tables: ask the library itself.
    return Counter(text[a:b] for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(text))


class _Batch:
    """Documents on their way into one packed batch."""

    def __init__(self):
        self.index: dict[str, int] = {}
        self.which, self.freq, self.lens = array("I"), array("I"), array("I")
        self.ids, self.sizes, self.chars = [], [], 0

    def add(self, doc_id: int | None, text: str, counts: Counter) -> None:
        index = self.index
        self.which.extend([index.setdefault(p, len(index)) for p in counts])
        self.freq.extend(counts.values())
        self.lens.append(len(counts))
        self.ids.append(doc_id)
        self.sizes.append(len(text.encode()))
        self.chars += len(text)

    @property
    def full(self) -> bool:
        return len(self.ids) == BATCH_DOCS or self.chars > BATCH_CHARS


def _pack(base: int, batch: _Batch, buckets: int) -> Iterator[pa.RecordBatch]:
    raw = [p.encode() for p in batch.index]
    which, freq = np.array(batch.which, np.int32), np.array(batch.freq, np.uint32)
    docs, ids, sizes = batch.ids, batch.ids, batch.sizes
    at = np.repeat(np.arange(len(docs), dtype=np.uint16), np.array(batch.lens, np.int64))
    held = np.bincount(which, minlength=len(raw))
    bucket = np.fromiter(map(zlib.crc32, raw), np.int64, len(raw))
    bucket = np.where(held > max(64, len(docs) // COMMON), bucket + zlib.crc32(str(base).encode()), bucket) % buckets
    size = np.fromiter(map(len, raw), np.uint32, len(raw))
    order = np.lexsort((which, bucket[which]))
    which, at, freq = which[order], at[order], freq[order]
    by_bucket = np.argsort(bucket, kind="stable")
    first = np.searchsorted(bucket[by_bucket], np.arange(buckets + 1))
    edge = np.searchsorted(bucket[which], np.arange(buckets + 1))
    own = zlib.crc32(f"own {base}".encode()) % buckets  # the bucket that also gets the ids of the batch
    names = ("bucket", "base", "texts", "lens", "rows", "at", "freq", "ids", "sizes")
    kinds = (pa.int32(), pa.int64(), *[pa.binary()] * 5, pa.list_(pa.int64()), pa.list_(pa.int64()))
    rows = []
    for b in range(buckets):
        mine, span = by_bucket[first[b]:first[b + 1]], slice(edge[b], edge[b + 1])
        if len(mine) or b == own:
            rows.append((b, base, b"".join([raw[i] for i in mine]), size[mine].tobytes(), held[mine].astype(np.uint16).tobytes(),
                         at[span].tobytes(), freq[span].tobytes(), ids if b == own else None, sizes if b == own else None))
        if rows and (len(rows) == SLICE or b == buckets - 1):
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=list(names))
            rows = []


def _frequencies(definition, specials: list[str], buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(definition.value)
        base = TaskContext.get().partitionId() << 36
        gathered = _Batch()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or ""
                gathered.add(doc_id, text, _split(text, specials, tokenizer))
                if gathered.full:
                    yield from _pack(base, gathered, buckets)
                    base += len(gathered.ids)
                    gathered = _Batch()
        if gathered.ids:
            yield from _pack(base, gathered, buckets)
    return run


def _count_and_join(definition):
    """Rows arrive sorted by bucket: count its pre-tokens once, join, and sum per document and batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(definition.value)
        current, known = None, {}
        for batch in batches:
            for row in range(batch.num_rows):
                bucket, base, texts, lens, rows, at, freq = (batch.column(i)[row].as_py() for i in range(7))
                if bucket != current:
                    current, known = bucket, {}
                ends = np.cumsum(np.frombuffer(lens, np.uint32), dtype=np.int64).tolist()
                words = [texts[a:b].decode() for a, b in zip([0, *ends], ends)]
                new = [w for w in words if w not in known]
                known.update(zip(new, _pieces_of(new, tokenizer).tolist()))
                pieces = np.fromiter((known[w] for w in words), np.int64, len(words))
                worth = np.repeat(pieces, np.frombuffer(rows, np.uint16)) * np.frombuffer(freq, np.uint32)
                tokens = np.bincount(np.frombuffer(at, np.uint16), worth).astype(np.int64)
                held = np.flatnonzero(tokens)
                dense = 5 * len(held) >= 4 * len(tokens)
                part = tokens if dense else tokens[held]
                width = np.uint32 if tokens.max(initial=0) < 1 << 32 else np.uint64
                yield pa.RecordBatch.from_arrays(
                    [pa.array([base]), pa.array([None if dense else held.astype(np.uint16).tobytes()], pa.binary()),
                     pa.array([part.astype(width).tobytes()], pa.binary()), pa.array([np.dtype(width).itemsize], pa.int32()),
                     batch.column(7).slice(row, 1), batch.column(8).slice(row, 1)],
                    names=["base", "at", "tokens", "width", "ids", "sizes"])
    return run


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by batch of documents: add up its sums, one row per document."""
    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(total[:len(ids)])],
                                          names=["doc_id", "n_bytes", "n_tokens"])

    current, total, ids, sizes = None, np.zeros(1 << 16, np.int64), [], []
    for batch in batches:
        for row in range(batch.num_rows):
            base, at, tokens, width, own, size = (batch.column(i)[row].as_py() for i in range(6))
            if base != current:
                if current is not None:
                    yield done()
                current, total[:] = base, 0
            tokens = np.frombuffer(tokens, np.uint32 if width == 4 else np.uint64).astype(np.int64)
            if at is None:
                total[:len(tokens)] += tokens
            else:
                total[np.frombuffer(at, np.uint16)] += tokens
            if own is not None:
                ids, sizes = own, size
    if current is not None:
        yield done()


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 1024, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per input row: the id, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit``
    (``n_tokens`` above ``limit``), as the tokenizers library counts with its defaults: special
    strings inside texts are one token each, none are added, nothing is cut.

    A null text counts as empty; an empty text has no tokens. Rows that repeat an id, even with the
    same text, each give a row. A null id stays null. An empty table gives an empty result. Other
    columns are ignored, whatever their names. The vocabulary file is read on the driver and sent
    to the workers; its size does not depend on the data.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = f.read()
    specials = [t.content for t in Tokenizer.from_str(definition).get_added_tokens_decoder().values()]
    specials.sort(key=len, reverse=True)
    sent = spark.sparkContext.broadcast(definition)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(
        _frequencies(sent, specials, partitions), _PACKED)
    parts = packed.repartition(partitions, "bucket").sortWithinPartitions("bucket").mapInArrow(
        _count_and_join(sent), "base long, at binary, tokens binary, width int, ids array<long>, sizes array<long>")
    sums = parts.repartition(partitions, "base").sortWithinPartitions("base").mapInArrow(
        _add_up, "doc_id long, n_bytes long, n_tokens long")
    return sums.withColumn("over_limit", F.col("n_tokens") > limit)
