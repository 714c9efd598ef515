"""Held-out accuracy and edge cases of language identification."""

import random
import zlib

import pytest

from tallyline.llm.langid import Model, grams_of, identify, keep_identified, predict, train

SYLLABLES = {"aa": ("ka", "lu", "mi", "to"), "bb": ("sch", "eng", "urt", "ost"), "cc": ("шко", "лай", "ми", "ро")}


def text(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 5))) for _ in range(n))


@pytest.fixture
def labelled(spark):
    rng = random.Random(7)
    rows = [(i, text(rng, lang, rng.randrange(3, 40)), lang) for i in range(240) for lang in (rng.choice("aabbcc") * 2,)]
    rows += [(1000, None, "aa"), (1001, "", "bb"), (1002, "12 34 !?", "cc"), (1003, text(rng, "aa", 5), None), (None, text(rng, "bb", 9), "bb"),
             (3, rows[3][1], rows[3][2]), (1004, "kalu " * 20000, "aa")]
    return spark.createDataFrame([(*r, "s", "x") for r in rows], "doc_id long, text string, lang string, source string, score string")


def test_held_out_rows_are_told(labelled):
    out = identify(labelled)
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"]
    out = out.collect()
    right = total = 0
    assert len(out) == labelled.count()
    lang = {r.doc_id: r.lang for r in labelled.collect()}
    for r in out:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1
        if r.doc_id in (1000, 1001, 1002):
            assert (r.lang_pred, r.score) == ("und", 0)
        elif r.held_out and lang[r.doc_id]:
            total += 1
            right += r.lang_pred == lang[r.doc_id]
    assert total > 40 and right / total > 0.95


def test_labels_of_held_out_rows_and_other_columns_say_nothing(labelled, spark):
    from pyspark.sql import functions as F

    from tallyline.llm.langid import held_out
    changed = labelled.withColumn("lang", F.when(held_out(), F.lit("zz")).otherwise(F.col("lang"))).withColumn("source", F.lit("t"))
    key = lambda r: (str(r.doc_id), r.lang_pred, r.score)
    assert sorted(map(key, identify(labelled).collect())) == sorted(map(key, identify(changed).collect()))


def test_table_accuracy(table):
    docs = table("documents", "/root/testdata/sf0.01")
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    held = [r for r in identify(docs).collect() if r.held_out and lang[r.doc_id]]
    assert len(held) > 200 and sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) > 0.97


def test_nothing_to_learn_from(documents):
    out = identify(documents([(0, "some words"), (1, "more")], lang=None)).collect()
    assert {(r.lang_pred, r.score) for r in out} == {("und", 0.0)}
    assert identify(documents([])).collect() == []


def test_backoff_reads_the_longest_known_gram():
    model = Model({"a": 1, "b": 1}, [("a", "kala", 5), ("b", "osto", 5)],
                  [("a", g, 1) for g in grams_of("kala")] + [("b", g, 1) for g in grams_of("osto")], {"a": 10, "b": 10})
    known, alike, other, unknown = model.score_words(["kala", "kalala", "ostos", "xyz"])
    assert known[0] > known[1] and alike[0] > alike[1] and other[1] > other[0]
    assert abs(unknown[0] - unknown[1]) < 1e-9  # only the marks of its edges are known
    assert model.predict(["kalat kalala", "ostosto", None, "1 2"])[0] == ["a", "b", "und", "und"]


def test_sampling_bounds_what_is_learnt(labelled):
    model = train(labelled, sample=60, words=5, grams=7)
    assert len(model.words) <= 15 and len(model.grams) <= 3 * 5 * 7
    assert predict(labelled, model).where("lang_pred = 'aa'").count() > 0


def test_filter_keeps_columns_and_known_texts(labelled):
    kept = keep_identified(labelled)
    assert kept.columns == labelled.columns
    gone = labelled.count() - kept.count()
    assert gone == 3  # null, empty, no letters
    assert {r.score for r in kept.collect()} == {"x"}


def test_a_rare_language_is_in_the_sample(spark):
    rows = [(k, f"alpha beta gamma w{k}", "common") for k in range(3000)] + [(3000 + k, "omega psi chi", "rare") for k in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = train(docs, sample=30)
    assert model.langs == ["common", "rare"] and sum(model.predict(["omega psi chi chi"])[0] == [lang] for lang in model.langs) == 1
    assert model.predict(["omega psi chi", "alpha beta"])[0] == ["rare", "common"]
    assert 0.99 < float(1 - 2.718281828 ** model.prior[1]) < 1  # as common as it is in all rows


def test_sample_by_language():
    from tallyline.llm.langid import _wanted
    counts = {"a": 90_000, "b": 40_000, "c": 300, "d": 1}
    wanted = _wanted(counts, 20_000)
    assert wanted["c"] == wanted["d"] == 1 and wanted["a"] == wanted["b"]
    assert abs(sum(wanted[k] * n for k, n in counts.items()) - 20_000) < 1
    assert max(abs(x - 0.2) for x in _wanted({"a": 50_000, "b": 50_000}, 20_000).values()) < 1e-6  # common ones: one share, as it was
