"""Generated dimension tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions.dates import date_int

# Chinese month and weekday names, January and Monday first.
CN_MONTHS = ("一月", "二月", "三月", "四月", "五月", "六月", "七月", "八月", "九月", "十月", "十一月", "十二月")
CN_WEEK = ("周一", "周二", "周三", "周四", "周五", "周六", "周日")
# Fixed value: sort numbers fall as dates rise.
ORDER_BASE = 20890520


def dim_date(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per calendar day from ``start`` to ``end``, both included."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date")))
                                 .alias("the_date"))
    return calendar_columns(days)


def calendar_columns(days: DataFrame, col: str = "the_date") -> DataFrame:
    """Calendar attributes of a table of days; weeks are ISO weeks, weekdays count from Monday = 0."""
    d = F.col(col)
    month, weekday = F.month(d), F.weekday(d)
    cn_month = F.array(*[F.lit(m) for m in CN_MONTHS])
    cn_week = F.array(*[F.lit(w) for w in CN_WEEK])
    return days.select(
        date_int(d).alias("id"), F.year(d).alias("the_year"),
        F.when(month <= 6, 1).otherwise(2).alias("half_year"), F.quarter(d).alias("the_quarter"),
        month.alias("month_of_year"), F.weekofyear(d).alias("week_of_year"),
        F.dayofmonth(d).alias("day_of_month"), weekday.alias("week_day"), d.alias("the_date"),
        (F.lit(ORDER_BASE) - date_int(d)).alias("order_no"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter_name"),
        F.date_format(d, "MMMM").alias("month_name"), F.date_format(d, "MMM").alias("abbr_month_name"),
        F.element_at(cn_month, month).alias("cn_month_name"),
        F.date_format(d, "EEEE").alias("week_name"), F.date_format(d, "EEE").alias("abbr_week_name"),
        F.element_at(cn_week, weekday + 1).alias("cn_week_name"))


def cohort_columns(gap: str | Column) -> dict[str, Column]:
    """Day, week, month, quarter and year number of a day gap (from 1); ``未知`` below zero."""
    g = F.col(gap) if isinstance(gap, str) else gap
    year = F.floor(g / 365)
    month = F.least(F.floor(F.pmod(g, F.lit(365)) / 30), F.lit(11))
    numbers = {"day_num": g + 1, "week_num": F.floor(g / 7) + 1, "month_num": year * 12 + month + 1,
               "quarter_num": year * 4 + F.floor(month / 3) + 1, "year_num": year + 1}
    return {name: F.when(g < 0, "未知").otherwise(n.cast("long").cast("string"))
            for name, n in numbers.items()}


def dim_cohort(spark: SparkSession, n: int = 3600) -> DataFrame:
    """Day gaps -1 (unknown) to ``n`` with their period numbers and count bands."""
    ids = spark.range(-1, n + 1).select(F.col("id").cast("int").alias("id"))
    return bucket_labels(ids.withColumns(cohort_columns("id")), "id")


# Upper bounds and labels of the bands, lowest band first; above the last bound
# comes the last label.
BANDS = {
    "times_1": ((0, 2, 5, 9, 19, 49),
                ("未知", "1-2次", "3-5次", "6-9次", "10-19次", "20-49次", "50次+")),
    "times_2": ((0, 1, 10), ("未知", "1次", "2-10次", "10次以上")),
    "times_3": ((0, 1, 2), ("0次", "1次", "2次", "3次+")),
    "count_1": ((0, 1, 10), ("未知", "1个", "2-10个", "10个以上")),
    "time_1": ((0, 3, 10, 30, 60, 180, 600, 1800),
               ("未知", "1~3秒", "4-10秒", "11-30秒", "31-60秒", "1-3分", "3-10分", "10-30分", "30分~")),
    "time_2": ((0, 1, 10, 30, 120),
               ("未知", "~1分", "1~10分", "10~30分", "30~120分", "2小时~")),
}


def band(value: str | Column, name: str) -> tuple[Column, Column]:
    """Number and label of the band a value falls in."""
    v = F.col(value) if isinstance(value, str) else value
    bounds, labels = BANDS[name]
    number, label = F.when(v <= bounds[0], 0), F.when(v <= bounds[0], labels[0])
    for i, bound in enumerate(bounds[1:], start=1):
        number, label = number.when(v <= bound, i), label.when(v <= bound, labels[i])
    return number.otherwise(len(bounds)), label.otherwise(labels[-1])


def bucket_labels(df: DataFrame, value: str, names: Sequence[str] = tuple(BANDS)) -> DataFrame:
    """Add band number and label columns (``name``, ``name_desc``) for ``value``."""
    added = {}
    for name in names:
        added[name], added[f"{name}_desc"] = band(value, name)
    return df.withColumns(added)


# Mobile operators by code, and product names by app key.
ISP_NAMES = {0: "未知", 46000: "中国移动", 46001: "中国联通", 46002: "中国移动", 46003: "中国电信",
             46007: "中国移动", 46099: "中国电信"}


def dim_isp(spark: SparkSession) -> DataFrame:
    """Operator codes and names."""
    return spark.createDataFrame(sorted(ISP_NAMES.items()), "id int, isp_name string")


def dim_product(spark: SparkSession, names: dict[str, str]) -> DataFrame:
    """App keys and product names, as given."""
    return spark.createDataFrame(sorted(names.items()), "id string, name string")


def label_isp(df: DataFrame, code: str = "isp_code") -> DataFrame:
    """Add isp_name by code; the table has seven rows, which bounds the broadcast."""
    names = dim_isp(df.sparkSession).withColumnRenamed("id", code)
    return df.join(F.broadcast(names), code, "left")
