"""Byte-level BPE over matrices of pre-tokens, and its inverse.

A task takes its texts a slice at a time and encodes every distinct pre-token of the slice once. Of
these, whole vocabulary entries are looked up; the rest become rows of padded matrices, one matrix
for each range of lengths. In every round each row merges its leftmost pair of minimum rank: the
ranks of pairs come from a hash table of (left id, right id), the merged id takes the place of the
pair, the ids behind it move up by one, and rows with nothing left to merge leave the matrix. A
document's ids are then gathered from those of its pre-tokens. Nothing is shuffled, and memory
follows the slice.

Rows of a matrix move as a whole, so a row costs the square of its length. A pre-token longer than
``LONGEST`` bytes (a run of letters without any break) is merged by the same rule over a heap.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.pretoken import pretokens

LONGEST = 512
SLICE_CHARS = 8 << 20
SLICE_IDS = 1 << 20
BUCKETS = (2, 3, 4, 5, 6, 7, 8, 10, 12, 14, 16, 20, 24, 32, 48, 64, 96, 128, 192, 256, 384, LONGEST)
CELLS = 1 << 19            # of a matrix
NONE = np.int32(2**31 - 1)  # rank of a pair that doesn't merge

_VOCABULARIES: dict[int, Vocabulary] = {}


class Vocabulary:
    """Ranks of a ``.tiktoken`` file: lines of base64 bytes and their id."""

    def __init__(self, definition: bytes):
        self.ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in definition.splitlines() if x)}
        self.bytes = {b: a for a, b in self.ranks.items()}
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        left, right, merged = [], [], []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(rank)
        self._build(np.array(left, np.int64), np.array(right, np.int64), np.array(merged, np.int32))

    def _build(self, left, right, merged):
        """An open-addressing table of pairs, filled by vectors: of the pairs that want the same
        slot one gets it, and the others look one slot on."""
        keys = (left << 32) | right
        self.bits = max(4, int(len(keys) * 4).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NONE, np.int32)
        slot, todo = self._slot(keys), np.arange(len(keys))
        self.probes = 0
        while len(todo):
            self.probes += 1
            free = todo[self.keys[slot[todo]] == -1]
            _, first = np.unique(slot[free], return_index=True)
            won = free[first]
            self.keys[slot[won]], self.values[slot[won]] = keys[won], merged[won]
            todo = todo[self.keys[slot[todo]] != keys[todo]]
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys):
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The id that each pair merges to, which is its rank too; ``NONE`` if it doesn't."""
        keys = (left.astype(np.int64) << 32) | right
        slot = self._slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.values[slot], NONE)
        open_ = np.flatnonzero((found != keys) & (found != -1))
        for _ in range(self.probes):
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            found = self.keys[slot[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.values[slot[open_[hit]]]
            open_ = open_[~hit & (found != -1)]
        return out

    def encode_rows(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many pre-tokens: flat, and how many each has."""
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        whole = np.fromiter((self.ranks.get(x, -1) for x in raw), np.int64, len(raw))
        parts: list[tuple[np.ndarray, np.ndarray]] = []  # rows, and a matrix of their ids padded by -1
        known = np.flatnonzero(whole >= 0)
        parts.append((known, whole[known].astype(np.int32)[:, None]))
        rest = np.flatnonzero((whole < 0) & (size > 0))
        bucket = np.searchsorted(BUCKETS, size[rest])
        for b, width in enumerate(BUCKETS):
            mine = rest[bucket == b]
            step = max(1, CELLS // width)
            for i in range(0, len(mine), step):
                rows = mine[i:i + step]
                parts.append((rows, self._merge([raw[j] for j in rows], width)))
        for j in rest[bucket == len(BUCKETS)]:
            parts.append((np.array([j]), self._merge_long(raw[j])[None, :]))
        n = np.zeros(len(raw), np.int64)
        for rows, ids in parts:
            n[rows] = (ids >= 0).sum(1)
        start = np.concatenate([[0], np.cumsum(n)])
        flat = np.empty(start[-1], np.int32)
        for rows, ids in parts:
            held = ids >= 0
            place = start[rows][:, None] + np.arange(ids.shape[1])
            flat[place[held]] = ids[held]
        return flat, n

    def _merge(self, raw: list[bytes], width: int) -> np.ndarray:
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        ids = np.full((len(raw), width), -1, np.int32)
        ids[np.arange(width) < size[:, None]] = self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        done = np.full_like(ids, -1)
        row = np.arange(len(raw))
        ranks = self._ranks(ids)
        while len(row):
            at = ranks.argmin(1)  # of equal minima the leftmost
            best = ranks[np.arange(len(row)), at]
            over = best == NONE
            if over.any():
                done[row[over], :ids.shape[1]] = ids[over]
                keep = ~over
                row, ids, ranks, at, best = row[keep], ids[keep], ranks[keep], at[keep], best[keep]
                if not len(row):
                    break
            k = np.arange(len(row))
            # Compaction: what stands behind the pair moves up by one.
            take = np.arange(ids.shape[1] - 1)[None, :] + (np.arange(ids.shape[1] - 1)[None, :] > at[:, None])
            ids = np.take_along_axis(ids, take, 1)
            ids[k, at] = best
            if ids.shape[1] == 1:
                done[row, :1] = ids
                break
            ranks = np.take_along_axis(ranks, np.minimum(take[:, :-1], ranks.shape[1] - 1), 1)
            for side in (at - 1, at):  # only the two pairs that touch the merged id are new
                ok = (side >= 0) & (side < ranks.shape[1])
                r, c = k[ok], side[ok]
                a, b = ids[r, c], ids[r, c + 1]
                ranks[r, c] = np.where((a >= 0) & (b >= 0), self.pair_ranks(a, b), NONE)
        return done

    def _ranks(self, ids: np.ndarray) -> np.ndarray:
        a, b = ids[:, :-1], ids[:, 1:]
        held = b >= 0
        out = np.full(a.shape, NONE, np.int32)
        out[held] = self.pair_ranks(a[held], b[held])
        return out

    def _merge_long(self, raw: bytes) -> np.ndarray:
        ids = self.byte_ids[np.frombuffer(raw, np.uint8)].tolist()
        n = len(ids)
        after, before, live = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        first = self.pair_ranks(np.array(ids[:-1], np.int64), np.array(ids[1:], np.int64)).tolist()
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(first) if r != NONE]
        heapq.heapify(heap)
        bytes_of, ranks = self.bytes, self.ranks
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if not live[i] or j >= n or ids[i] != a or ids[j] != b:
                continue
            ids[i], live[j], after[i] = rank, False, after[j]
            if after[j] < n:
                before[after[j]] = i
            for x in (before[i], i):
                if x >= 0 and after[x] < n:
                    y = after[x]
                    r = ranks.get(bytes_of[ids[x]] + bytes_of[ids[y]])
                    if r is not None:
                        heapq.heappush(heap, (r, x, ids[x], ids[y]))
        return np.array([x for x, alive in zip(ids, live) if alive], np.int32)

    def decode_rows(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of the ids up to each end: flat, and where each row ends. Ids that the
        vocabulary doesn't have are an error."""
        if not hasattr(self, "_flat"):
            top = max(self.bytes) + 1
            self._size = np.array([len(self.bytes.get(i, b"")) for i in range(top)], np.int64)
            self._flat = np.frombuffer(b"".join(self.bytes.get(i, b"") for i in range(top)), np.uint8)
            self._start = np.cumsum(self._size) - self._size
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self._size) or (self._size[ids] == 0).any()):
            raise ValueError("an id is not in the vocabulary")
        size = self._size[ids]
        stop = np.cumsum(size)
        place = np.arange(stop[-1] if len(stop) else 0) + np.repeat(self._start[ids] - (stop - size), size)
        return self._flat[place], np.concatenate([[0], stop])[ends]


def _vocabulary(definition: bytes) -> Vocabulary:
    key = hash(definition)
    if key not in _VOCABULARIES:
        _VOCABULARIES[key] = Vocabulary(definition)
    return _VOCABULARIES[key]


def _slices(batch: pa.RecordBatch, column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose values of a column have about so many bytes or elements; a longer value is alone."""
    values = batch.column(column)
    lens = pc.list_value_length(values) if pa.types.is_list(values.type) else pc.binary_length(values)
    start = size = 0
    for i, n in enumerate(pc.fill_null(lens, 0).to_pylist()):
        if i > start and size + n > limit:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if batch.num_rows > start:
        yield batch.slice(start)


def _encoder(definition, text: int, out: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(definition.value)
        for batch in batches:
            for part in _slices(batch, text, SLICE_CHARS):
                index: dict[str, int] = {}
                which, counts = [], []
                for value in part.column(text).to_pylist():
                    found = pretokens(value) if value else ()
                    which.extend([index.setdefault(p, len(index)) for p in found])
                    counts.append(len(found))
                flat, n = vocabulary.encode_rows([p.encode() for p in index])
                start = np.cumsum(n) - n
                which = np.array(which, np.int64)
                size = n[which]
                stop = np.cumsum(size)
                ids = flat[np.arange(stop[-1] if len(stop) else 0) + np.repeat(start[which] - (stop - size), size)]
                ends = np.concatenate([[0], stop])[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)]
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], names=[*part.schema.names, out])
    return run


def _decoder(definition, ids: int, out: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(definition.value)
        for batch in batches:
            for part in _slices(batch, ids, SLICE_IDS):
                column = part.column(ids)
                ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False))])
                flat, stop = vocabulary.decode_rows(column.flatten().to_numpy(zero_copy_only=False).astype(np.int64),
                                                    ends.astype(np.int64))
                data = pa.Array.from_buffers(pa.large_binary(), len(stop) - 1,
                                             [None, pa.py_buffer(stop.astype(np.int64).tobytes()), pa.py_buffer(flat.tobytes())])
                yield pa.RecordBatch.from_arrays([*part.columns, data.cast(pa.binary())], names=[*part.schema.names, out])
    return run


def _definition(docs: DataFrame, path: str):
    with open(path, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, ranks_path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """The rows and columns given, and the ids of the whole text, without special tokens, as the
    tiktoken library gives them for these ranks.

    A null or empty text has an empty list of ids. Repeated rows are encoded alike. A column that
    already has the name of the ids is replaced; others are carried along. The rank file is read on
    the driver and sent to the workers; its size does not depend on the data.
    """
    docs = docs.drop(ids_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(_encoder(_definition(docs, ranks_path), docs.columns.index(text_col), ids_col),
                           f"{schema}, `{ids_col}` array<int>")


def decode(encoded: DataFrame, ranks_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """The rows and columns given, and the bytes that the ids stand for. A null or empty list gives
    empty bytes; an id that the vocabulary lacks is an error."""
    encoded = encoded.drop(out_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(_decoder(_definition(encoded, ranks_path), encoded.columns.index(ids_col), out_col),
                              f"{schema}, `{out_col}` binary")


def digests(docs: DataFrame, ranks_path: str) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids and of the decoded bytes, for ``doc_id`` and ``text``."""
    ids = encode(docs.select("doc_id", "text"), ranks_path).select("doc_id", "ids")
    both = decode(ids, ranks_path)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
