"""Archives that are written, split at any byte, and read."""

import gzip
import io
import random
import zlib

import pytest

from tallyline.llm import warc
from tallyline.llm.warc import digest, parse, record, records

PAGES = [(3, "http://a/ x\r\n", "<p>same</p>"), (1, None, "<p>same</p>"), (1, "http://b", "<p>same</p>"), (7, "http://c", None),
         (8, "http://d", ""), (None, "http://e", "<p>same</p>"), (None, "http://f", "<p>only without id</p>"),
         (9, "http://g", "é\r\n\r\nWARC/1.1\r\n" * 2000), (10, "http://h", "<p>é 日本</p>")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload string")


def expected(rows, least=0):
    first = {}
    for i, _, html in rows:
        h = (html or "").encode()
        if i is not None:
            first[h] = min(i, first.get(h, i))
    out = []
    for i, _, html in rows:
        h = (html or "").encode()
        f = first.get(h) if len(h) >= least else None
        again = f is not None and f != i
        out.append((str(i), len(h), digest(h), "revisit" if again else "response", f if again else None))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, least):
    assert rows_of(warc.round_trip(frame(spark, PAGES), least)) == expected(PAGES, least)


def test_empty_table(spark):
    assert warc.round_trip(frame(spark, [])).collect() == []


def test_table(table):
    pages = table("pages")
    assert rows_of(warc.round_trip(pages)) == expected([(r.page_id, r.url, r.html) for r in pages.collect()])


def test_payloads_and_places_survive(spark, tmp_path):
    warc.write(frame(spark, PAGES), str(tmp_path))
    out = warc.read(spark, str(tmp_path), split=700).collect()
    assert len(out) == len(PAGES) and len({(r.path, r.offset) for r in out}) == len(PAGES)
    responses = {(r.page_id, bytes(r.payload).decode()) for r in out if r.record_type == "response"}
    assert responses == {(i, h or "") for i, _, h in PAGES if (i, h) not in ((3, "<p>same</p>"), (8, ""), (None, "<p>same</p>"))}
    assert {r.url for r in out} == {"http://a/%20x%0D%0A", None, *(u for _, u, _ in PAGES[2:])}
    whole = b"".join(gzip.decompress(p.read_bytes()) for p in sorted(tmp_path.glob("*.gz")))  # any gzip reader reads them
    assert whole.count(b"WARC-Record-ID") == len(PAGES)


def _archive(rng, n):
    """Members, some of incompressible payloads that hold the magic bytes and stored blocks."""
    raw = []
    for k in range(n):
        payload = bytes(rng.randrange(256) for _ in range(rng.choice((0, 10, 3000)))) + warc.MAGIC * rng.randrange(3)
        text = record(k, f"http://{k}", payload, None, False)
        packer = zlib.compressobj(rng.choice((0, 4)), zlib.DEFLATED, 31)
        raw.append((text, packer.compress(text) + packer.flush()))
    return raw


@pytest.mark.parametrize("split", [1, 37, 1000, 10**6])
def test_every_record_has_one_owner(split, monkeypatch):
    monkeypatch.setattr(warc, "READ", 64)
    members = _archive(random.Random(split), 12 if split == 1 else 40)
    data = b"".join(m for _, m in members)
    found = [r for at in range(0, len(data), split) for r in records(io.BytesIO(data), at, at + split)]
    assert [t for _, t in found] == [t for t, _ in members]
    assert [o for o, _ in found] == [sum(len(m) for _, m in members[:k]) for k in range(len(members))]


def test_torn_ends_and_strange_members_are_skipped():
    good = _archive(random.Random(1), 3)
    other = gzip.compress(b"not a record, but a member")
    data = other + good[0][1] + warc.MAGIC + good[1][1] + other + good[2][1][:-5]
    assert [t for _, t in records(io.BytesIO(data), 0, len(data))] == [good[0][0], good[1][0]]


def test_a_damaged_payload_is_an_error():
    text = record(1, "u", b"payload", None, False)
    assert parse(text)["payload"] == b"payload"
    with pytest.raises(ValueError, match="damaged"):
        parse(text.replace(b"payload\r\n\r\n", b"Payload\r\n\r\n"))
