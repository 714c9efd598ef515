"""All similar pairs of sparse vectors, by a prefix filter over an inverted index of their keys.

Equal vectors are one vector with a number of copies. Keys are ordered from rare to frequent, and of
each vector only its first keys are indexed: those up to the point from which the rest could no
longer reach the threshold by itself. Two vectors that reach it must share an indexed key, so lists
are short where keys are rare and the frequent keys are hardly indexed at all. Lists that are long
all the same are dealt into blocks, and every two blocks meet in a task of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions.vectors import cosine, pearson
from tallyline.operators.skew import lookup
from tallyline.session import written

BLOCK = 2000   # vectors of a key's list that meet another such block in one task
SLACK = 1e-9   # for sums of doubles in another order
FLOAT_SLACK = 1e-6  # for bounds of unit vectors from single-precision weights and lengths


def _classed(vectors: DataFrame) -> DataFrame:
    entries = F.array_sort(F.map_entries("vector"))
    return vectors.where(F.col("id").isNotNull() & F.col("vector").isNotNull()).select("id", entries.alias("entries"))


def distinct_vectors(vectors: DataFrame) -> DataFrame:
    """(id, vector, copies): one row for each different vector, under the smallest id that has it.

    Copies combine before the shuffle, so that a vector that a third of all ids share is one row per
    input partition. Rows without id or vector are left out.
    """
    return (_classed(vectors).groupBy(F.xxhash64("entries").alias("_h"), "entries")
            .agg(F.min("id").alias("id"), F.count("*").alias("copies"))
            .select("id", F.map_from_entries("entries").alias("vector"), "copies"))


def vector_classes(vectors: DataFrame) -> DataFrame:
    """(id, representative): the smallest id with the same vector, for every id."""
    rows = _classed(vectors).withColumn("_h", F.xxhash64("entries"))
    least = rows.groupBy("_h", "entries").agg(F.min("id").alias("representative"))
    return rows.join(written(least, "classes"), ["_h", "entries"]).select("id", "representative")


def _indexed(vectors: DataFrame, least: float, measure: str, shared: int) -> DataFrame:
    """(key, id, rest, later0, later1, hot): the indexed keys of each vector; with cosine also ``weight``.

    Cosine: weights of the unit vector; ``rest`` is the length of what follows in key order, and a
    key is indexed while the part from it on has a bound of ``least`` or more, by its length or by
    the largest weight that any vector has for each of its keys. Pearson needs ``shared`` keys in
    common and knows no bound beside that: ``rest`` is the number of keys that follow. ``later``
    has a bit, by hash, for each key that follows: without a common bit two vectors share none of
    these. Keys of more than ``BLOCK`` vectors are ``hot``. Reads ``vectors`` twice.
    """
    rows = vectors.select("id", F.explode("vector").alias("key", "weight"))
    if measure == "cosine":
        length = F.sqrt(F.aggregate(F.map_values("vector"), F.lit(0.0), lambda acc, w: acc + w * w))
        units = vectors.select(length.alias("_size"), F.explode("vector").alias("key", "weight")).where("weight != 0")
        keys = units.groupBy("key").agg(F.count("*").alias("_n"), F.max(F.abs(F.col("weight") / F.col("_size"))).alias("_top"))
        rows = rows.where("weight != 0")
    else:
        rows = rows.drop("weight")
        keys = rows.groupBy("key").agg(F.count("*").alias("_n"))
    ranked = lookup(rows, written(keys.where("_n > 1"), "keys"), "key")
    # From the last key backwards, so that a running sum is that of the part from a key on. A key that no other
    # vector has adds nothing to any pair; it counts for the size and stands behind all others.
    back = Window.partitionBy("id").orderBy(F.desc_nulls_last("_n"), F.desc("key"))
    part = back.rowsBetween(Window.unboundedPreceding, 0)
    slot = F.pmod(F.xxhash64("key"), F.lit(128))
    for k in range(2):
        bit = F.when(F.floor(slot / 64) == k, F.expr("shiftleft(1L, cast(pmod(xxhash64(key), 64L) as int))")).otherwise(F.lit(0).cast("long"))
        found = F.bit_or(bit).over(back.rowsBetween(Window.unboundedPreceding, -1))
        ranked = ranked.withColumn(f"later{k}", F.coalesce(found, F.lit(0).cast("long")))
    known = ["key", "id", "later0", "later1", (F.col("_n") > BLOCK).alias("hot")]
    if measure == "cosine":
        size = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(back.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        ranked = ranked.withColumn("weight", F.col("weight") / size)
        square = F.sum(F.col("weight") * F.col("weight")).over(part)
        tops = F.sum(F.abs("weight") * F.col("_top")).over(part)
        ranked = ranked.withColumns({"_square": square, "_tops": tops}).where("_n IS NOT NULL")
        bound = F.least(F.sqrt("_square"), F.col("_tops"))
        rest = F.sqrt(F.greatest(F.col("_square") - F.col("weight") * F.col("weight"), F.lit(0.0)))
        return ranked.where(bound >= least - SLACK).select(*known, F.col("weight").cast("float").alias("weight"), rest.cast("float").alias("rest"))
    ranked = ranked.withColumn("_left", F.count("*").over(part)).where("_n IS NOT NULL")
    return ranked.where(F.col("_left") >= shared).select(*known, (F.col("_left") - 1).cast("int").alias("rest"))


def candidate_pairs(vectors: DataFrame, least: float, measure: str = "cosine", shared: int = 2) -> DataFrame:
    """(a, b) with a < b: pairs of ``vectors`` (id, vector), all different, that may reach ``least``.

    Pairs are built by the join of the index with itself, and a pair whose bound at a shared key
    (the product of the weights plus, if they may share a key that follows, the product of the
    lengths that follow) is below the threshold is dropped there, before any shuffle; with Pearson,
    a pair that shares no key that follows. A pair that reaches the threshold passes at the first
    key that both share.
    """
    index = written(_indexed(vectors, least, measure, shared), "index")
    carried = {"weight": "_w", "rest": "_r", "later0": "_p", "later1": "_q"}

    def side(rows: DataFrame, name: str, *more: Column) -> DataFrame:
        return rows.select("key", F.col("id").alias(name), *[F.col(c).alias(f"{short}{name}") for c, short in carried.items() if c in rows.columns], *more)

    meet = (F.col("_px").bitwiseAND(F.col("_py")) != 0) | (F.col("_qx").bitwiseAND(F.col("_qy")) != 0)
    if measure == "cosine":
        double = lambda c: F.col(c).cast("double")
        follow = F.when(meet, double("_rx") * double("_ry")).otherwise(0.0)
        bound: Column = F.abs(double("_wx") * double("_wy")) + follow >= least - FLOAT_SLACK
    else:
        bound = (F.least("_rx", "_ry") + 1 >= shared) & meet
    few = index.where(~F.col("hot"))  # both sides are the same rows: one shuffle
    pairs = side(few, "x").join(side(few, "y"), "key").where((F.col("x") < F.col("y")) & bound).select(F.col("x").alias("a"), F.col("y").alias("b"))

    many = index.where("hot")
    lists = many.groupBy("key").agg(F.count("*").alias("_n")).where("_n > 1")
    dealt = lookup(many, written(lists.select("key", F.ceil(F.col("_n") / BLOCK).cast("int").alias("_blocks")), "lists"), "key")
    dealt = dealt.where("_blocks IS NOT NULL").withColumn("_own", F.expr("cast(pmod(xxhash64(id), _blocks) as int)"))
    left = side(dealt, "x", F.col("_own").alias("_i"), F.expr("explode(sequence(_own, _blocks - 1)) AS _j"))
    right = side(dealt, "y", F.col("_own").alias("_j"), F.expr("explode(sequence(0, _own)) AS _i"))
    once = (F.col("_i") < F.col("_j")) | (F.col("x") < F.col("y"))  # inside a block by order, between blocks each way
    hot = (left.join(right, ["key", "_i", "_j"]).where(once & bound)
           .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")))
    return pairs.unionByName(hot).distinct()


def similar_pairs(vectors: DataFrame, least: float, measure: str = "cosine", shared: int = 2) -> DataFrame:
    """(a, b, similarity, copies_a, copies_b): every pair of different vectors of ``vectors``
    (id, vector) whose similarity is ``least`` or more, under the smallest ids that have them.

    ``measure`` is ``cosine``, or ``pearson`` over the keys that both have, of which there must be
    ``shared`` (two at least, since one key has no variance). ``least`` must be positive. Copies of
    a vector are not paired with each other; :func:`vector_classes` tells whose copies they are.
    """
    if least <= 0 or measure not in ("cosine", "pearson") or shared < 2:
        raise ValueError("least must be positive, measure cosine or pearson, and shared two or more")
    known = written(distinct_vectors(vectors), "vectors")
    pairs = written(candidate_pairs(known.select("id", "vector"), least, measure, shared), "pairs")
    for name in "ab":
        pairs = lookup(pairs, known.select(F.col("id").alias(name), F.col("vector").alias(f"_v{name}"), F.col("copies").alias(f"copies_{name}")), name)
    if measure == "cosine":
        similarity = cosine("_va", "_vb")
    else:
        common = F.size(F.array_intersect(F.map_keys("_va"), F.map_keys("_vb")))
        similarity = F.when(common >= shared, pearson("_va", "_vb"))
    return (pairs.select("a", "b", similarity.alias("similarity"), "copies_a", "copies_b")
            .where(F.col("similarity") >= least))
