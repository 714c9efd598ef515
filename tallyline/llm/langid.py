"""Language of a text: known words first, character n-grams for the rest.

A word that the labelled texts have is scored by its log frequency in each language. A word that
they lack backs off to its characters: at every place the longest known n-gram from there on speaks,
a shorter one only where no longer one is known. A text's scores are the sums over its words and
the languages' shares.

Counting runs over the labelled rows in Spark. The model is bounded by parameters: labelled rows are
thinned by a hash to about ``SAMPLE``, and ``WORDS`` words and ``GRAMS`` n-grams of each length are
kept per language, for at most ``LANGUAGES`` languages. So it can be sent to every task, and
predicting needs no shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import free_name, saved
from tallyline.operators.skew import top_per_key

SAMPLE = 20_000
LANGUAGES = 200
WORDS = 30_000
GRAMS = 20_000
LONGEST = 5
SLICE_CHARS = 4 << 20
UNKNOWN = "und"
_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def grams_of(word: str) -> list[str]:
    """All n-grams of a word between marks of its edges, one to ``LONGEST`` characters."""
    w = f"^{word}$"
    return [w[i:i + n] for n in range(1, LONGEST + 1) for i in range(len(w) - n + 1)]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: dict[str, Counter] = {}
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts.setdefault(lang, Counter()).update(words_of(text))
        rows = [(lang, w, n) for lang, c in counts.items() for w, n in c.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()),
             pa.array([r[2] for r in rows], pa.int64())], names=["lang", "word", "n"])


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: dict[str, Counter] = {}
        for lang, word, n in zip(*(batch.column(i).to_pylist() for i in range(3))):
            own = counts.setdefault(lang, Counter())
            for g in grams_of(word):
                own[g] += n
        rows = [(lang, g, n) for lang, c in counts.items() for g, n in c.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()),
             pa.array([r[2] for r in rows], pa.int64())], names=["lang", "gram", "n"])


class Model:
    """Log scores per language, as tables from words and n-grams to a row of scores."""

    def __init__(self, shares: dict[str, int], words: list[tuple], grams: list[tuple], totals: dict[str, int]):
        self.langs = sorted(shares)
        at = {lang: i for i, lang in enumerate(self.langs)}
        size = np.array([max(1, totals.get(lang, 0)) for lang in self.langs], float)
        share = np.array([shares[lang] for lang in self.langs], float)
        self.prior = np.log(share / share.sum()) if len(share) else share
        self.words, counts = self._table(words, at)
        self.word_scores = np.log((counts + 0.5) / (size + 0.5 * max(1, len(self.words))))
        self.grams, counts = self._table(grams, at)
        rate = counts / size + 1e-7  # what an n-gram says of a language: its share of the rates
        self.gram_scores = np.log(rate / rate.sum(1, keepdims=True)) if len(counts) else counts

    def _table(self, rows: list[tuple], at: dict[str, int]) -> tuple[dict[str, int], np.ndarray]:
        index: dict[str, int] = {}
        places = [(index.setdefault(key, len(index)), at[lang], n) for lang, key, n in rows if lang in at]
        counts = np.zeros((len(index), len(self.langs)))
        for i, j, n in places:
            counts[i, j] += n
        return index, counts

    def score_words(self, words: list[str]) -> np.ndarray:
        """A row of log scores for each word."""
        out = np.zeros((len(words), len(self.langs)))
        known = np.fromiter((self.words.get(w, -1) for w in words), np.int64, len(words))
        out[known >= 0] = self.word_scores[known[known >= 0]]
        unseen = np.flatnonzero(known < 0)
        get, found, counts = self.grams.get, [], []
        for i in unseen.tolist():
            w, before = f"^{words[i]}$", len(found)
            for a in range(len(w)):
                for n in range(min(LONGEST, len(w) - a), 0, -1):
                    g = get(w[a:a + n])
                    if g is not None:
                        found.append(g)
                        break
            counts.append(len(found) - before)
        counts = np.array(counts, np.int64)
        some = counts > 0
        if some.any():
            start = (np.cumsum(counts) - counts)[some]
            sums = np.add.reduceat(self.gram_scores[np.array(found, np.int64)], start, axis=0)
            out[unseen[some]] = sums / counts[some][:, None] * 2  # an unseen word weighs about two places
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        index: dict[str, int] = {}
        which, freq, lens = [], [], []
        for text in texts:
            counts = Counter(words_of(text))
            which.extend([index.setdefault(w, len(index)) for w in counts])
            freq.extend(counts.values())
            lens.append(len(counts))
        langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not self.langs or not index:
            return langs, scores
        table = self.score_words(list(index))
        which, freq, lens = np.array(which), np.array(freq, float), np.array(lens, np.int64)
        some = np.flatnonzero(lens)
        start = (np.cumsum(lens) - lens)[some]
        total = np.add.reduceat(table[which] * freq[:, None], start, axis=0)
        n = np.add.reduceat(freq, start)
        total = total * np.minimum(1, 50 / n)[:, None] + self.prior  # words of one text aren't independent
        total -= total.max(1, keepdims=True)
        chance = np.exp(total)
        chance /= chance.sum(1, keepdims=True)
        best = chance.argmax(1)
        for i, b, p in zip(some.tolist(), best.tolist(), chance[np.arange(len(best)), best].tolist()):
            langs[i], scores[i] = self.langs[b], p
        return langs, scores


def _wanted(counts: dict[str, int], sample: int) -> dict[str, float]:
    """The share of each language's rows to learn from: one share for all, but more of a language that
    would have less than an even part of half the sample, about ``sample`` rows together."""
    even = sample / 2 / max(1, len(counts))
    low, high = 0.0, 1.0
    for _ in range(60):
        share = (low + high) / 2
        if sum(max(min(n, even), share * n) for n in counts.values()) > sample:
            high = share
        else:
            low = share
    return {lang: max(min(n, even) / n, low) for lang, n in counts.items()}


def train(docs: DataFrame, sample: int = SAMPLE, words: int = WORDS, grams: int = GRAMS) -> Model:
    """Learn from rows with ``text`` and ``lang``. Rows with a null of either say nothing; without
    any, the model knows no language and predicts ``und``. Of more than ``sample`` rows about so many
    are learnt from, with a part of them for every language however rare; how common languages are is
    taken from all rows. Languages beyond the ``LANGUAGES`` most frequent aren't learnt."""
    rows = docs.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang", "doc_id")
    n = rows.count()
    shares = dict(rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect())
    if n > sample:  # by a hash that copies of a text don't share
        wanted = F.create_map(*(F.lit(x) for lang, share in _wanted(shares, sample).items() for x in (lang, int(share * (1 << 30)))))
        rows = rows.where(F.pmod(F.xxhash64("text", "doc_id"), F.lit(1 << 30)) < F.try_element_at(wanted, F.col("lang")))
    picked = rows.select("text", "lang")
    counts = saved(picked.mapInArrow(_count_words, "lang string, word string, n long")
                   .groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    totals = {r[0]: r[1] for r in counts.groupBy("lang").agg(F.sum("n")).collect()} if shares else {}
    top = top_per_key(counts.where("n > 1"), ["lang"], [F.desc("n"), F.asc("word")], words).select("lang", "word", "n").collect()
    pieces = counts.mapInArrow(_count_grams, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    pieces = pieces.withColumn("size", F.length("gram"))
    best = top_per_key(pieces, ["lang", "size"], [F.desc("n"), F.asc("gram")], grams).select("lang", "gram", "n").collect()
    return Model(shares, [tuple(r) for r in top], [tuple(r) for r in best], totals)


def _predict(sent, text: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            start = size = 0
            column = batch.column(text)
            for i in range(batch.num_rows + 1):
                n = len(column[i].as_py() or "") if i < batch.num_rows else 0
                if i == batch.num_rows or (i > start and size + n > SLICE_CHARS):
                    part = batch.slice(start, i - start)
                    langs, scores = model.predict(part.column(text).to_pylist())
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                                     names=[*part.schema.names, "lang_pred", "score"])
                    start, size = i, 0
                size += n
    return run


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows and columns given, ``lang_pred`` (``und`` if a text is null or has no letter) and
    ``score``, the chance of that language from 0 to 1 (0 for ``und``). Only the text is looked at;
    repeated rows are predicted alike."""
    docs = docs.drop("lang_pred", "score")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(_predict(sent, docs.columns.index(text_col)), f"{schema}, lang_pred string, score double")


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a row is kept from training, by its id; a row without id isn't."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row, learnt from those that aren't held out."""
    model = train(docs.where(~held_out()))
    return predict(docs.select("doc_id", held_out().alias("held_out"), "text"), model).drop("text")


def keep_identified(docs: DataFrame, least: float = 0.3) -> DataFrame:
    """The documents, as given, whose language can be told: not ``und``, and no less likely than
    ``least``."""
    own = {c: free_name(docs, f"own_{c}") for c in docs.columns if c.lower() in ("lang_pred", "score")}
    model = train(docs.where(~held_out()))
    kept = predict(docs.withColumnsRenamed(own), model).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
    return kept.drop("lang_pred", "score").withColumnsRenamed({v: k for k, v in own.items()})
