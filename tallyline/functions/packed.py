"""Packed text columns: ``id:weight`` lists, ``a~b`` lists and composite ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_pairs(c: str | Column) -> Column:
    """``id:weight,id:weight`` to an array of structs ``(tag long, weight double)``.

    Entries without a numeric id and weight are left out, so that bad text cannot stop a job.
    """
    entries = F.transform(
        F.split(_col(c), ","),
        lambda e: F.struct(
            F.trim(F.split_part(e, F.lit(":"), F.lit(1))).try_cast("long").alias("tag"),
            F.trim(F.split_part(e, F.lit(":"), F.lit(2))).try_cast("double").alias("weight"),
        ),
    )
    return F.filter(entries, lambda p: p["tag"].isNotNull() & p["weight"].isNotNull())


def format_pairs(c: str | Column) -> Column:
    """Array of two-field structs to ``id:weight,id:weight``."""
    return F.array_join(
        F.transform(_col(c), lambda p: F.concat_ws(":", p["tag"].cast("string"),
                                                   p["weight"].cast("string"))), ",")


def explode_packed(df: DataFrame, c: str, names: str | tuple[str, ...], sep: str = ",",
                   inner: str | None = None) -> DataFrame:
    """One row per entry of a packed list; with ``inner`` every entry is split into ``names``.

    Empty entries give no row. The packed column is dropped before rows multiply.
    """
    names = (names,) if isinstance(names, str) else tuple(names)
    entries = F.filter(F.split(F.col(c), "\\Q" + sep + "\\E"), lambda e: e != "")
    rows = df.withColumn("_entries", entries).drop(c).withColumn("_entry", F.explode("_entries"))
    if inner is None:
        return rows.withColumn(names[0], F.col("_entry")).drop("_entries", "_entry")
    parts = {n: F.nullif(F.split_part(F.col("_entry"), F.lit(inner), F.lit(i)), F.lit(""))
             for i, n in enumerate(names, start=1)}
    return rows.withColumns(parts).drop("_entries", "_entry")


def composite_id(model: str | Column, item: str | Column) -> Column:
    """``model-id`` key of a content row."""
    return F.concat_ws("-", _col(model).cast("string"), _col(item).cast("string"))


def composite_model(c: str | Column) -> Column:
    """The model part of a composite id, as a number."""
    return F.substring_index(_col(c), "-", 1).try_cast("int")


def composite_item(c: str | Column) -> Column:
    """Everything behind the first dash of a composite id, as a number."""
    return F.regexp_replace(_col(c), "^[^-]*-", "").try_cast("long")
