"""Content-defined chunks of lines."""

import random
from collections import Counter

import pytest
import xxhash

from tallyline.llm import line_dedup
from tallyline.llm.line_dedup import chunks, dedup_lines


def brute(rows, **options):
    """The rule by hand: every chunk but its first occurrence, by id, text and place, goes."""
    def key(text):
        h = xxhash.xxh64_intdigest((text or "").encode(), 42)
        return h - (1 << 64) if h >> 63 else h
    places = {}
    for i, t in set(rows):
        for start, n in chunks(t, **options) if t else ():
            body = "\n".join(t.split("\n")[start:start + n])
            places.setdefault(body, set()).add((i is None, i or 0, key(t), start))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        gone = set()
        for start, n in chunks(t, **options) if t else ():
            if (i is None, i or 0, key(t), start) != min(places["\n".join(lines[start:start + n])]):
                gone.update(range(start, start + n))
        out.append((str(i), "\n".join(x for k, x in enumerate(lines) if k not in gone) if gone else t, len(gone)))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((str(r.doc_id), r.text, r.n_removed) for r in df.collect()), key=str)


def sentence(rng, n=8):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))


def corpus(rng, n=60):
    """Documents of lines of their own, some with one of a few passages somewhere."""
    passages = [[sentence(rng) for _ in range(k)] for k in (3, 5, 8, 12)]
    rows = []
    for i in range(n):
        lines = [sentence(rng) for _ in range(rng.randrange(1, 9))]
        if i % 2:
            at = rng.randrange(len(lines) + 1)
            lines[at:at] = rng.choice(passages)
        rows.append((i, "\n".join(lines)))
    return rows, passages


def test_rule(documents):
    rows, _ = corpus(random.Random(1))
    rows += [(200, None), (201, ""), (202, "\n\n\n"), (203, rows[1][1]), (203, rows[1][1]), (None, rows[3][1]), (None, rows[3][1]),
             (204, "long " * 60 + "\nown line"), (205, "before\n" + "long " * 60), (1, rows[5][1]), (206, "a b\n" * 400)]
    docs = documents(rows).withColumnRenamed("extra", "n_lines")
    out = dedup_lines(docs, report=True)
    assert out.columns == [*docs.columns, "_n_lines", "n_removed"]
    assert rows_of(out) == brute(rows)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in out.collect())
    assert dedup_lines(docs).columns == docs.columns
    assert dedup_lines(documents([])).count() == 0


def test_shared_passages_are_found_wherever_they_stand(documents):
    rng = random.Random(2)
    rows, passages = corpus(rng, 300)
    out = {r.doc_id: r.text for r in dedup_lines(documents(rows)).collect()}
    line_of = {line: k for k, p in enumerate(passages) for line in p}
    before, after = Counter(), Counter()
    for i, t in rows:
        before.update(x for x in t.split("\n") if x in line_of)
        after.update(x for x in out[i].split("\n") if x in line_of)
        assert [x for x in t.split("\n") if x not in line_of] == [x for x in out[i].split("\n") if x and x not in line_of]
    assert all(after[x] >= 1 for x in line_of)  # the first stays
    assert sum(after.values()) - len(line_of) < 0.1 * (sum(before.values()) - len(line_of))


def test_boundaries_do_not_shift():
    rng = random.Random(3)
    lines = [sentence(rng) for _ in range(40)]
    bodies = {"\n".join(lines[s:s + n]) for s, n in chunks("\n".join(lines))}
    moved = [sentence(rng) for _ in range(3)] + lines
    again = {"\n".join(moved[s:s + n]) for s, n in chunks("\n".join(moved))}
    assert len(bodies & again) > 0.85 * len(bodies)


def test_same_hash_of_other_bytes_removes_nothing(documents, monkeypatch):
    """All chunks get one hash: their bytes differ, so none may go."""
    def find(passes, long_line):
        real = line_dedup_find(passes, long_line)

        def run(batches):
            import pyarrow as pa
            for b in real(batches):
                yield pa.RecordBatch.from_arrays([pa.array([7] * b.num_rows, pa.int64()), *b.columns[1:]], schema=b.schema)
        return run
    line_dedup_find = line_dedup._find
    monkeypatch.setattr(line_dedup, "_find", find)
    rows = [(1, "one line\nand two"), (2, "some other\ntwo lines")]
    assert {r.text for r in dedup_lines(documents(rows), passes=8).collect()} == {t for _, t in rows}


@pytest.mark.parametrize("long_line", [3, 50])
def test_long_lines_count_alone(documents, long_line):
    rows = [(1, "a\none two three four\nb"), (2, "c\none two three four\nd")]
    out = {r.doc_id: r.text for r in dedup_lines(documents(rows), long_line=long_line).collect()}
    assert out == {1: rows[0][1], 2: "c\nd" if long_line == 3 else rows[1][1]}


@pytest.mark.parametrize("copies", [2, 40])
@pytest.mark.parametrize("length", [2, 3, 5, 8, 12])
def test_passages_of_any_length_go_whole(length, copies):
    """By length and number of copies: every line of a repeated passage is in a chunk that each copy has."""
    rng = random.Random(length * 100 + copies)
    for _ in range(20):
        passage = [sentence(rng) for _ in range(length)]
        left = 0
        seen = set()
        for k in range(copies):
            lines = [sentence(rng) for _ in range(rng.randrange(4))] + passage + [sentence(rng) for _ in range(rng.randrange(4))]
            spans = [("\n".join(lines[s:s + n]), s, n) for s, n in chunks("\n".join(lines))]
            gone = {i for body, s, n in spans if body in seen for i in range(s, s + n)}
            left += sum(line in passage and i not in gone for i, line in enumerate(lines)) if k else 0
            seen.update(body for body, _, _ in spans)
        assert left == 0


def test_short_passages_go_whole(documents):
    rng = random.Random(5)
    two, three = [sentence(rng) for _ in range(2)], ["", sentence(rng), "", " ", sentence(rng), sentence(rng), ""]
    rows = [(i, "\n".join([sentence(rng), *(two if i % 2 else three), sentence(rng)])) for i in range(8)]
    out = {r.doc_id: r.text.split("\n") for r in dedup_lines(documents(rows)).collect()}
    for i, t in rows:
        lines = t.split("\n")
        assert [x for x in out[i] if x.strip()] == ([x for x in lines if x.strip()] if i < 2 else [lines[0], lines[-1]])


def test_overlapping_pairs_leave_the_first(documents):
    rows = [(1, "x\nsame\nsame\nsame\ny"), (2, "p\nsame\nsame\nsame\nq"), (3, "same\n" * 4 + "z"), (4, "other\n" * 5 + "w")]
    out = {r.doc_id: r.text for r in dedup_lines(documents(rows)).collect()}
    assert out == {1: rows[0][1], 2: "p\nq", 3: "z", 4: "other\nother\nw"}
