"""Counts over sets of grouping columns."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Rules = list[tuple[str, list[str]]]


def parse_rules(text: str) -> Rules:
    """Lines ``code a,b`` to (code, columns)."""
    lines = [line.split() for line in text.splitlines() if line.strip()]
    return [(code, cols.split(",")) for code, cols in lines]


def combination_rules(cols: Sequence[str], must: Sequence[str] = ()) -> Rules:
    """All column combinations by size, numbered ``l_1`` on; ``must`` precedes every set and, when
    given, is the first set by itself."""
    must = list(must)
    sets = [must] if must else []
    for size in range(1, len(cols) + 1):
        sets += [must + list(c) for c in combinations(cols, size)]
    width = len(str(len(cols)))
    return [(f"l_{i:0{width}d}", s) for i, s in enumerate(sets, start=1)]


def _rollup(df: DataFrame, rules: Rules, key: str, count: str) -> DataFrame:
    """One pass for all rules: count per finest group, then grouping sets over those counts.

    Rules with the same columns, in whatever order, share a set; every rule gets its rows. A column
    that a rule names twice counts once.
    """
    columns = list(dict.fromkeys(c for _, cols in rules for c in cols))
    finest = df.groupBy(*columns).agg(F.count(key).alias("_n"))
    n = len(columns)
    sets: dict[frozenset, list[str]] = {}
    for code, cols in rules:
        sets.setdefault(frozenset(cols), []).append(code)
    # bit i of the grouping id (from the left) is 1 where the column is rolled away
    codes = F.create_map(*[x for cols, found in sets.items() for x in (
        F.lit(sum((c not in cols) << (n - 1 - i) for i, c in enumerate(columns))).cast("long"),
        F.array(*map(F.lit, found)))])
    grouped = finest.groupingSets([[c for c in columns if c in cols] for cols in sets], *columns)
    return (grouped.agg(F.sum("_n").alias(count), F.grouping_id().cast("long").alias("_gid"))
            .select(F.explode(codes[F.col("_gid")]).alias("rule"), *columns, count))


def rollup_new(df: DataFrame, rules: Rules, key: str = "aid", count: str = "fact_count") -> DataFrame:
    """New users counted for every rule; ``rule`` tells the sets apart, unused columns are null."""
    return _rollup(df, rules, key, count)


def rollup_active(df: DataFrame, rules: Rules | None = None, key: str = "aid",
                  count: str = "fact_count", day: int | None = None) -> DataFrame:
    """Active users counted for every rule, by default all sets of channel and area beside the
    active date, creation date and day gap. ``day`` (yyyyMMdd) recomputes one active date."""
    rows = df if day is None else df.where(F.col("active_date") == day)
    rules = rules or combination_rules(["channel_code", "area"],
                                       ["active_date", "create_date", "date_diff"])
    return _rollup(rows, rules, key, count)


def split_rollup(rolled: DataFrame, rules: Rules) -> dict[str, DataFrame]:
    """The roll-up as one table per rule with only the rule's columns."""
    counts = [c for c in rolled.columns if c.endswith("count")]
    return {code: rolled.where(F.col("rule") == code).select(*cols, *counts) for code, cols in rules}


# Column sets of the client reports, and the calendar columns of the monthly one.
CLIENT_RULES: Rules = [
    ("l_02", ["app_key", "create_date"]),
    ("l_03", ["app_key", "create_date", "customer_id"]),
    ("l_04", ["app_key", "create_date", "pkg_path"]),
    ("l_05", ["app_key", "create_date", "version"]),
    ("l_06", ["app_key", "create_date", "is_upgrade"]),
    ("l_07", ["app_key", "create_date", "version", "is_upgrade"]),
]
CALENDAR = ["the_year", "half_year", "the_quarter", "month_of_year"]


def client_rollups(clients: DataFrame, dim_date: DataFrame) -> dict[str, DataFrame]:
    """Clients per calendar month (``calendar``) and per column set (``sets``).

    Clients are counted per app and day before they meet the date table.
    """
    daily = clients.groupBy("app_key", "create_date").agg(F.count("*").alias("_n"))
    dates = dim_date.select(F.col("id").alias("create_date"), *CALENDAR)
    calendar = (daily.join(dates, "create_date").groupBy("app_key", *CALENDAR)
                .agg(F.sum("_n").alias("fact_count")))
    return {"calendar": calendar, "sets": _rollup(clients, CLIENT_RULES, "app_key", "fact_count")}


# --- stored roll-ups that are kept up to date by day ---------------------------------------------

FINEST = "finest"  # the rule of the counts by all columns, from which a day can be taken back


def _all_columns(rules: Rules) -> list[str]:
    return list(dict.fromkeys(c for _, cols in rules for c in cols))


def finest_counts(df: DataFrame, rules: Rules, key: str) -> DataFrame:
    """Rows, and rows with a ``key``, by all columns that the rules name."""
    return df.groupBy(*_all_columns(rules)).agg(F.count("*").alias("fact_rows"), F.count(key).alias("fact_count"))


def rollup_delta(new: DataFrame, old: DataFrame | None, rules: Rules) -> DataFrame:
    """What replacing the finest counts ``old`` by ``new`` adds to the groups of all rules, less or
    more than nothing: (group, rule, columns, fact_rows, fact_count). Groups that stay as they are
    leave no row. ``group`` is a digest of rule and columns."""
    columns = _all_columns(rules)
    signed = new.select(*columns, "fact_rows", "fact_count")
    if old is not None:
        signed = signed.unionByName(old.select(*columns, (-F.col("fact_rows")).alias("fact_rows"), (-F.col("fact_count")).alias("fact_count")))
    sums = [F.sum(c).alias(c) for c in ("fact_rows", "fact_count")]
    signed = signed.groupBy(*columns).agg(*sums).where("fact_rows <> 0 OR fact_count <> 0")
    sets: dict[int, list[str]] = {}
    for code, cols in [*rules, (FINEST, columns)]:
        gone = sum((c not in cols) << (len(columns) - 1 - i) for i, c in enumerate(columns))
        sets.setdefault(gone, []).append(code)
    codes = F.create_map(*[x for gone, found in sets.items() for x in (F.lit(gone).cast("long"), F.array(*map(F.lit, found)))])
    kept = [[c for i, c in enumerate(columns) if not gone >> (len(columns) - 1 - i) & 1] for gone in sets]
    rolled = (signed.groupingSets(kept, *columns).agg(*sums, F.grouping_id().cast("long").alias("_gid"))
              .where("fact_rows <> 0 OR fact_count <> 0").select(F.explode(codes[F.col("_gid")]).alias("rule"), *columns, "fact_rows", "fact_count"))
    return rolled.select(F.md5(F.to_json(F.struct("rule", *columns))).alias("group"), *rolled.columns)


def apply_delta(stored: DataFrame | None, delta: DataFrame, co_located: bool = False) -> DataFrame:
    """The stored roll-up with a delta; groups without rows vanish. ``co_located`` says that it is
    stored by buckets of ``group`` and stays where it is; the sum is the same."""
    if stored is None:
        return delta.where("fact_rows > 0")
    sums = ("fact_rows", "fact_count")
    names = [c for c in delta.columns if c != "group" and c not in sums]
    if not co_located:
        both = stored.select(delta.columns).unionByName(delta)
        return both.groupBy("group", *names).agg(*[F.sum(c).alias(c) for c in sums]).where("fact_rows > 0")
    a, b = stored.alias("a"), delta.alias("b")
    known = F.col("a.rule").isNotNull()
    met = a.join(b, "group", "full_outer").select(
        "group", *[F.when(known, F.col(f"a.{c}")).otherwise(F.col(f"b.{c}")).alias(c) for c in names],
        *[(F.coalesce(F.col(f"a.{c}"), F.lit(0)) + F.coalesce(F.col(f"b.{c}"), F.lit(0))).alias(c) for c in sums])
    return met.where("fact_rows > 0")


def refresh_day(stored: DataFrame | None, rows: DataFrame, rules: Rules, key: str, col: str, day: int | str,
                co_located: bool = False) -> DataFrame:
    """The stored roll-up with the rows of one day (``col``) in the place of those it had.

    The day's old finest counts are read back from the roll-up itself, so that table and roll-up
    cannot get out of step; all other sets, also those without the day, change by the difference.
    The work is that of one day, and redoing a day twice changes nothing.
    """
    new = finest_counts(rows.where(F.col(col) == day), rules, key)
    old = None if stored is None else stored.where((F.col("rule") == FINEST) & (F.col(col) == day))
    return apply_delta(stored, rollup_delta(new, old, rules), co_located)


def stored_counts(stored: DataFrame) -> DataFrame:
    """The roll-up in the shape of :func:`rollup_new`: rule, columns and count."""
    return stored.where(F.col("rule") != FINEST).drop("group", "fact_rows")
