"""Row-level cleaning: filters and column expressions, all JVM-side."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Operator codes an imsi may start with, in the order of the operator table.
ISP_CODES = (46000, 46001, 46002, 46003, 46007, 46099)

# Sortable spelling of link names in the two log families. Plain text order then
# is link order; names above "2" carry no prefix.
NETWORK_KEYS = {
    "fad": {"UNKNOWN": "-Unknown", "WIFI": "0WIFI", "GPRS": "1GPRS"},
    "sdk": {"UNKNOWN": "0Unknown", "WIFI": "1WIFI"},
}


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def has_text(c: str | Column) -> Column:
    """True when the value is neither null nor empty."""
    return F.coalesce(_col(c) > F.lit(""), F.lit(False))


def require_non_empty(df: DataFrame, cols: Iterable[str] = (),
                      max_len: Mapping[str, int] | None = None) -> DataFrame:
    """Keep rows whose ``cols`` hold text and whose ``max_len`` columns fit their limit.

    A null in a length-limited column fails its test, as it does in SQL.
    """
    tests = [F.col(c) > "" for c in cols]
    tests += [F.length(c) <= n for c, n in (max_len or {}).items()]
    return df.where(reduce(lambda a, b: a & b, tests)) if tests else df


def rank_network(c: str | Column, style: str = "fad") -> Column:
    """Link name as text that sorts by link quality, so that ``max`` picks the best link.

    The fad logs keep any other name (cut to eight characters); the sdk logs know five names.
    """
    keys = NETWORK_KEYS[style]
    value = F.upper(_col(c))
    expr = F.when(~has_text(c), keys["UNKNOWN"])
    for name, key in keys.items():
        expr = expr.when(value == name, key)
    if style == "fad":
        return expr.otherwise(F.substring(_col(c), 1, 8))
    return expr.when(value.isin("2G", "3G", "4G"), value).otherwise(keys["UNKNOWN"])


def unrank_network(key: str | Column) -> Column:
    """The link name behind a sortable key."""
    return F.when(_col(key) < "2", F.substring(_col(key), 2, 64)).otherwise(_col(key))


def network_from_text(c: str | Column, exact: bool = False) -> Column:
    """Link name from free text, first match wins; ``exact`` asks for the whole name instead."""
    value = _col(c)
    names = ("4G", "3G", "2G", "WIFI")
    if exact:
        return F.when(value.isin(*names), value)
    expr = F.when(value.contains(names[0]), F.lit(names[0]))
    for name in names[1:]:
        expr = expr.when(value.contains(name), F.lit(name))
    return expr.otherwise(F.lit("unknown"))


def normalize_flags(df: DataFrame) -> DataFrame:
    """Numeric codes for the flag columns that are present in ``df``."""
    rules = {
        "isroot": F.when(F.col("isroot") == "1", 1).otherwise(2),
        "gp": F.when(F.col("gp") == "1", 1).otherwise(2),
        "havaapn": F.when(F.col("havaapn") == "1", 1).otherwise(0),
        "path": F.when(F.col("path").isin("1", "2", "3", "4", "5"),
                       F.expr("try_cast(path AS int)")).otherwise(0),
    }
    present = {c: rule for c, rule in rules.items() if c in df.columns}
    return df.withColumns(present) if present else df


def clip_text(c: str | Column, n: int) -> Column:
    """The first ``n`` characters."""
    return F.substring(_col(c), 1, n)


def default_unknown(df: DataFrame, cols: Iterable[str], default: str | None = "unknown") -> DataFrame:
    """Replace null and empty text by ``default`` (``None`` makes it null)."""
    return df.withColumns({c: F.when(has_text(c), F.col(c)).otherwise(F.lit(default)) for c in cols})


def bucket_minutes(ms: str | Column) -> Column:
    """Milliseconds to whole minutes: 0 when missing, at least 1, 121 above two hours."""
    minutes = _col(ms) / F.lit(60000)
    return (F.when(_col(ms).isNull() | (_col(ms) <= 0), 0)
            .when(minutes < 1, 1)
            .when(minutes > 120, 121)
            .otherwise(F.round(minutes))).cast("int")


def clamp_percent(c: str | Column, strict: bool = False) -> Column:
    """Force a percentage into 0..100; ``strict`` turns anything outside 1..100 into 0."""
    value = _col(c)
    if strict:
        return F.when((value > 0) & (value <= 100), value).otherwise(0).cast("int")
    return (F.when(value.isNull() | (value <= 0), 0)
            .when(value > 100, 100)
            .otherwise(value)).cast("int")


def duration_seconds(ms: str | Column) -> Column:
    """Seconds of a stay, rounded up; null unless it lies strictly between 0 and one hour."""
    value = _col(ms)
    return F.when((value > 0) & (value < 3600000), F.ceil(value / 1000)).cast("long")


def session_seconds(total_ms: str | Column) -> Column:
    """Seconds of a session: rounded, 0 counts as 1, a negative clock jump counts by its size."""
    seconds = F.round(_col(total_ms) / 1000)
    return (F.when(seconds > 0, seconds)
            .when(seconds == 0, 1)
            .otherwise(F.abs(seconds))).cast("long")


def isp_code(imsi: str | Column, known_only: bool = False) -> Column:
    """Operator code: the first five digits as a number, null when they are none.

    ``known_only`` maps every code outside the operator table to 0.
    """
    code = F.substring(_col(imsi), 1, 5)
    number = F.when(code.rlike("^[0-9]{5}$"), code.try_cast("int"))
    if known_only:
        return F.when(number.isin(*ISP_CODES), number).otherwise(0)
    return number


def add_optional_column(df: DataFrame, name: str, default, dtype: str | None = None) -> DataFrame:
    """Supply a column an older log lacks; an existing one only has its nulls filled."""
    fill = F.lit(default).cast(dtype) if dtype else F.lit(default)
    if name in df.columns:
        return df.withColumn(name, F.coalesce(F.col(name), fill))
    return df.withColumn(name, fill)


def label_codes(c: str | Column, labels: Mapping, other: str = "未知") -> Column:
    """Readable label of a code; ``other`` for any code without one."""
    value = _col(c)
    expr = None
    for code, label in labels.items():
        test = value == F.lit(code)
        expr = F.when(test, label) if expr is None else expr.when(test, label)
    return F.lit(other) if expr is None else expr.otherwise(other)


# Labels the reports print for coded columns.
YES_NO = {1: "是"}
SOURCE_PLATFORM = {1: "自媒体", 2: "其他"}
CONTENT_TYPE = {0: "资讯", 1: "视频"}
TASK_STATE = {0: "等待", 1: "就绪", 2: "已经分配", 3: "正在运行", 6: "运行成功", 9: "运行失败"}
