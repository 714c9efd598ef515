"""The pipeline against its stages by brute force."""

import hashlib

import corpus_pipeline
import tiktoken

from tests.llm.test_decontam import brute as brute_benchmark
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_simhash import brute_groups, brute_print

SF = "/root/testdata/sf0.001"


def brute(docs, items):
    rows = [(i, t) for i, t in docs if t and any(c.isalpha() for c in t)]
    rows = [(int(i), t) for i, t, _ in brute_lines(rows)]
    rows.sort()
    groups = brute_groups([(i, brute_print(t)) for i, t in rows])
    rows = [(i, t) for (i, t), g in zip(rows, groups) if i == g]
    bad = {int(r[0]) for r in brute_benchmark(rows, items) if r[5]}
    return [(i, t) for i, t in rows if i not in bad]


def test_run(spark, table):
    docs = [(r.doc_id, r.text) for r in table("documents").collect()]
    items = [(r.item_id, r.text) for r in table("benchmark").collect()]
    want = brute(docs, items)
    with open(corpus_pipeline.RANKS, "rb") as f:
        import base64
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""",
                                mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert sorted(got) == [i for i, _ in want]
    for i, t in want:
        assert list(got[i].ids) == library.encode_ordinary(t)
        assert got[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
        assert got[i].n_tokens == len(got[i].ids)


def test_stages_keep_the_columns(spark, documents):
    rows = [(1, "some words of a text\nin two lines"), (2, None), (3, ""), (None, "a text without id"), (1, "some words of a text\nin two lines")]
    for make in (rows, []):
        docs = documents(make)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns and out.dtypes == docs.dtypes
            out.collect()


def test_registered():
    import __spark_entry__ as contract
    names = set(contract.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert {"op2_embedding_dedup", "op5_warc", "op10_decontamination"} <= set(contract.oracle_sql())


def test_queries_match_their_sql(spark):
    import os
    import sys

    import pytest

    import __spark_entry__ as contract
    sys.path.insert(0, os.path.join(os.path.dirname(contract.__file__), "tools"))
    from check_oracles import connect, rows_of
    if not os.path.isdir(SF):
        pytest.skip("test tables are not here")
    con = connect(SF)
    for name in ("op2_embedding_dedup", "op5_warc", "op10_decontamination"):
        got = contract.queries()[name](spark, SF)
        want = con.execute(contract.oracle_sql()[name])
        names = [d[0] for d in want.description]
        assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == rows_of(names, want.fetchall()), name
