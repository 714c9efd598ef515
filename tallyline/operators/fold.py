"""Fold the rows of a key in time order into one row.

Every policy is a ``min`` or ``max`` over a struct (time, source, values). Such aggregates combine
before the shuffle and do not depend on row order: ties in time are broken by the source (the
stored table before the log) and then by the values themselves.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SOURCE = "_source"  # 0 = stored table, 1 = log


@dataclass(frozen=True)
class Policy:
    """Which value of a column survives the fold.

    first / last: of the earliest / latest row. first_known / last_known: earliest / latest usable
    value. highest: the maximum. Words in ``unknown`` (any letter case), null, empty text and
    numbers of 0 or less are not usable values.
    """

    first: tuple[str, ...] = ()
    last: tuple[str, ...] = ()
    first_known: tuple[str, ...] = ()
    last_known: tuple[str, ...] = ()
    highest: tuple[str, ...] = ()
    unknown: tuple[str, ...] = ("null", "unknown")

    def columns(self) -> list[str]:
        return [*self.first, *self.last, *self.first_known, *self.last_known, *self.highest]


def usable(df: DataFrame, c: str, unknown: Sequence[str]) -> Column:
    """Test for a usable value by the type of the column."""
    dtype = df.schema[c].dataType
    if isinstance(dtype, T.StringType):
        return (F.col(c) > "") & ~F.lower(F.col(c)).isin(*unknown)
    if isinstance(dtype, T.NumericType):
        return F.col(c) > 0
    return F.col(c).isNotNull()


def _terms(df: DataFrame, policy: Policy, start: str, end: str) -> tuple[list[tuple], dict[str, Column]]:
    """What a fold keeps of every row: (name, min or max, least or greatest, value), and how the
    columns come out of the kept ones."""
    source = [SOURCE] if SOURCE in df.columns else []
    early = [F.col(c).alias(f"_o{i}") for i, c in enumerate([start, *source])]
    late = [F.col(c).alias(f"_o{i}") for i, c in enumerate([end, *source])]
    terms, outputs = [], {}
    if policy.first:
        terms.append(("_first", F.min, F.least, F.struct(*early, *policy.first)))
        outputs.update({c: F.col(f"_first.{c}") for c in policy.first})
    if policy.last:
        terms.append(("_last", F.max, F.greatest, F.struct(*late, *policy.last)))
        outputs.update({c: F.col(f"_last.{c}") for c in policy.last})
    for columns, pick, join, order in ((policy.first_known, F.min, F.least, early), (policy.last_known, F.max, F.greatest, late)):
        for c in columns:
            row = F.when(usable(df, c, policy.unknown), F.struct(*order, F.col(c).alias("v")))
            terms.append((f"_known_{c}", pick, join, row))
            outputs[c] = F.col(f"_known_{c}.v")
    for c in policy.highest:
        terms.append((f"_max_{c}", F.max, F.greatest, F.col(c)))
        outputs[c] = F.col(f"_max_{c}")
    return terms, outputs


def fold(df: DataFrame, keys: Sequence[str], policy: Policy, start: str = "create_time",
         end: str = "update_time") -> DataFrame:
    """One row per ``keys``: "first" looks at ``start``, "last" at ``end``."""
    terms, outputs = _terms(df, policy, start, end)
    ordered = [c for c in df.columns if c in outputs]
    return (df.groupBy(*keys).agg(*[pick(value).alias(name) for name, pick, _, value in terms])
            .select(*keys, *[outputs[c].alias(c) for c in ordered]))


def fold_into(current: DataFrame, log: DataFrame, keys: Sequence[str], policy: Policy, start: str = "create_time",
              end: str = "update_time") -> DataFrame:
    """The fold of a stored table and a log, without moving the table.

    The log is folded by itself and joined to the table, where the kept values of both sides meet.
    A table that is stored by buckets of the keys is read in place: only the folded log is shuffled,
    to the table's buckets. Rows without a key are nobody's and are dropped.
    """
    keys = list(keys)
    stored = current.select(*[F.col(c).cast(log.schema[c].dataType).alias(c) for c in log.columns])
    sides, outputs = [], {}
    for source, rows in enumerate((stored, log)):
        rows = rows.dropna(subset=keys).withColumn(SOURCE, F.lit(source))
        terms, outputs = _terms(rows, policy, start, end)
        if source:
            rows = rows.groupBy(*keys).agg(*[pick(value).alias(f"{name}_new") for name, pick, _, value in terms])
        else:
            rows = rows.select(*keys, *[value.alias(f"{name}_old") for name, _, _, value in terms])
        sides.append(rows)
    met = sides[0].join(sides[1], keys, "full_outer")
    met = met.select(*keys, *[join(f"{name}_old", f"{name}_new").alias(name) for name, _, join, _ in terms])
    return met.select(*keys, *[outputs[c].alias(c) for c in log.columns if c in outputs])


def with_source(current: DataFrame | None, log: DataFrame) -> DataFrame:
    """Stored rows and log rows under one schema, tagged with their source."""
    rows = log.withColumn(SOURCE, F.lit(1))
    if current is None:
        return rows
    stored = current.select(*log.columns).withColumn(SOURCE, F.lit(0))
    return stored.unionByName(rows)
