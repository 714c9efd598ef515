"""Building blocks that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The optimizer limits a ranked group before its shuffle up to this rank
# (spark.sql.optimizer.windowGroupLimitThreshold); above it the limit is done in two steps here.
_BUILT_IN_GROUP_LIMIT = 1000
_SALTS = 64
_NULL_SPREAD = 1024


def bucketed_lag(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                 bucket: str, out: str) -> DataFrame:
    """Add ``out``: the ``value`` of the previous row of the same ``keys`` in ``order``.

    ``bucket`` (such as a day) must not fall as ``order`` rises. Rows are windowed per key and
    bucket, so that a hot key is spread over its buckets; the last value of each bucket is carried
    to the first row of the next one through a table of one row per key and bucket.
    """
    keys = list(keys)
    inside = Window.partitionBy(*keys, bucket).orderBy(*order)
    rows = df.withColumn("_prev", F.lag(F.struct(F.col(value).alias("v"))).over(inside))
    # The tail carries every column although only the value is needed: both branches then ask for
    # the same columns of ``df``, so an exchange below them is computed once and reused.
    others = [c for c in df.columns if c not in {*keys, *order, value, bucket}]
    tail = F.max(F.struct(*order, F.col(value).alias("_v"), *others))
    across = Window.partitionBy(*keys).orderBy(bucket)
    carried = (df.groupBy(*keys, bucket).agg(tail.alias("_tail"))
               .select(*keys, bucket, F.lag("_tail").over(across).alias("_carry")))
    return (rows.join(carried, [*keys, bucket], "left")
            .withColumn(out, F.when(F.col("_prev").isNotNull(), F.col("_prev.v"))
                        .otherwise(F.col("_carry._v")))
            .drop("_prev", "_carry"))


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int | str,
                rank: str = "_rank") -> DataFrame:
    """The first ``n`` rows of every key with their position in ``rank``; ``n`` is a number or a
    column that is the same on all rows of a key.

    ``order`` must end with a unique column. Up to 1000 rows the optimizer cuts every group inside
    each input partition before the shuffle; for more, or a column, the same is done by an explicit
    salt.
    """
    most = F.col(n) if isinstance(n, str) else F.lit(n)
    if isinstance(n, str) or n > _BUILT_IN_GROUP_LIMIT:
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(_SALTS)))
        part = Window.partitionBy(*keys, "_salt").orderBy(*order)
        df = (salted.withColumn("_part_rank", F.row_number().over(part))
              .where(F.col("_part_rank") <= most).drop("_salt", "_part_rank"))
    whole = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(whole)).where(F.col(rank) <= most)


def lookup(df: DataFrame, table: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Left join of a large ``df`` with a ``table`` that holds every ``key`` at most once.

    One pass over ``df`` and one shuffle: a partition that a hot key makes too large is split at
    run time by the adaptive skew join (the row of ``table`` is then read by every split), also where
    ``table`` is an aggregate on the same key, which is shuffled once more for that. Rows
    without a key match nothing; they are spread by a hash of the row instead of meeting in the
    one partition of null.
    """
    keys = [key] if isinstance(key, str) else list(key)
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    # Always 0, but not a constant that the optimizer could drop from the join where a later filter
    # rules out null: an aggregate on the keys would then share its stage with the join, unsplit.
    zero = F.pmod(F.hash(*keys), F.lit(1))
    spread = F.when(complete, zero).otherwise(F.pmod(F.xxhash64(*plain), F.lit(_NULL_SPREAD)).cast("int"))
    return (df.withColumn("_spread", spread)
            .join(table.withColumn("_spread", zero), [*keys, "_spread"], "left").drop("_spread")
            .select(*df.columns, *[c for c in table.columns if c not in keys]))


def distinct_users(df: DataFrame, keys: Sequence[str], user: str,
                   flags: dict[str, Column]) -> DataFrame:
    """Distinct users per key for several conditions at once.

    One row per key and user is built first (with partial aggregation), then the flags are summed:
    two plain aggregations instead of one row copy per condition.
    """
    per_user = df.groupBy(*keys, user).agg(
        *[F.max(F.when(cond, 1).otherwise(0)).alias(name) for name, cond in flags.items()])
    per_user = per_user.where(F.col(user).isNotNull())
    sums = [F.sum(name).alias(name) for name in flags]
    return (per_user.groupBy(*keys) if keys else per_user.groupBy()).agg(*sums)
