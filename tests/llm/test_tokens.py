"""Token counts and byte-level BPE against the libraries themselves."""

import base64
import hashlib
import random

import public_tokenizers
import pytest
import regex
import tiktoken
from tokenizers import Tokenizer

from tallyline.llm import bpe, pretoken, token_count
from tallyline.llm.bpe import Vocabulary, decode, digests, encode
from tallyline.llm.token_count import count_tokens

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ODD = ["", None, " ", "\n\n  x", "it's he'll I'D", "a" * 3000, "x" * 600 + " " + "y" * 511, "日本語 テキスト", "é     ½ ²",
       "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "🙂🙃 \U0001f9ff", "\x00\x1c\x1f \x85", "1234567 89", "   ", "Ünï çødé"]


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_pattern_is_the_public_one():
    assert pretoken.PATTERN == public_tokenizers.PATTERN


def test_plain_engine_splits_as_the_full_one():
    full = regex.compile(pretoken.PATTERN)
    rng = random.Random(1)
    for _ in range(400):
        text = "".join(chr(rng.choice((rng.randrange(128), rng.randrange(0x250), 32, 10, 39, 115))) for _ in range(60))
        assert pretoken.is_plain(text) and pretoken.pretokens(text) == full.findall(text)
    for c in map(chr, range(0x250)):
        assert pretoken.pretokens(f"a{c}b {c}1") == full.findall(f"a{c}b {c}1")


def _expected(texts):
    t = Tokenizer.from_file(JSON)
    return [len(e.ids) for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_counts_of_odd_texts(documents, monkeypatch):
    monkeypatch.setattr(token_count, "BATCH_DOCS", 5)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, ODD[3]), (3, "another text of the same id"), (None, "no id"), (None, None)]
    out = count_tokens(documents(rows), JSON, limit=100).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in out) == sorted(
        (str(i), len((t or "").encode()), n, n > 100) for (i, t), n in zip(rows, _expected([t for _, t in rows])))


def test_counts_of_the_table(table):
    docs = table("documents")
    rows = docs.select("doc_id", "text").collect()
    got = {r.doc_id: r.n_tokens for r in count_tokens(docs, JSON).collect()}
    assert got == dict(zip((r.doc_id for r in rows), _expected([r.text for r in rows])))


def test_counts_of_an_empty_table(documents):
    out = count_tokens(documents([]), JSON)
    assert out.collect() == [] and out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]


def test_bpe_of_odd_texts(documents, library):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, ODD[3]), (None, "no id")]
    docs = documents(rows).withColumnRenamed("extra", "ids")
    both = decode(encode(docs, RANKS), RANKS)
    assert both.columns == [*[c for c in docs.columns if c != "ids"], "ids", "decoded"]
    out = both.collect()
    assert len(out) == len(rows)
    for r in out:
        assert list(r.ids) == library.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()


def test_bpe_digests_of_the_table(table, library):
    docs = table("documents")
    got = {r.doc_id: r for r in digests(docs, RANKS).collect()}
    for r in docs.collect():
        ids = library.encode_ordinary(r.text or "")
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


def test_bpe_of_an_empty_table(documents):
    assert digests(documents([]), RANKS).collect() == []


def test_merges_of_random_rows_match(library):
    with open(RANKS, "rb") as f:
        vocabulary = Vocabulary(f.read())
    rng = random.Random(4)
    raw = [bytes(rng.choice(b"thesinora") for _ in range(rng.choice((1, 2, 3, 7, 9, 33, 200, 700)))) for _ in range(300)]
    flat, n = vocabulary.encode_rows(raw)
    at = 0
    for text, k in zip(raw, n.tolist()):
        assert flat[at:at + k].tolist() == library.encode_ordinary(text.decode())
        at += k


def test_small_slices_change_nothing(documents, monkeypatch, library):
    batch = __import__("pyarrow").RecordBatch.from_pylist([{"text": t} for t in ODD * 3])
    monkeypatch.setattr(bpe, "SLICE_CHARS", 40)
    monkeypatch.setattr(bpe, "CELLS", 64)

    class Sent:
        value = open(RANKS, "rb").read()
    got = [x for part in bpe._encoder(Sent, 0, "ids")([batch]) for x in part.column(1).to_pylist()]
    assert got == [library.encode_ordinary(t or "") for t in ODD * 3]


def test_unknown_ids_are_an_error(spark):
    with pytest.raises(Exception, match="not in the vocabulary"):
        decode(spark.createDataFrame([([1, 2_000_000],)], "ids array<int>"), RANKS).collect()
