"""Column functions on hand rows."""

import math

import pytest
from pyspark.sql import functions as F

from tallyline.functions import clean, dates, packed, vectors
from tallyline.operators import dims
from tests.conftest import table


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def column(rows, ddl, values, expr):
    return [r[0] for r in rows(f"i int, {ddl}", [(i, v) for i, v in enumerate(values)]).orderBy("i").select(expr).collect()]


def test_require_non_empty(rows):
    df = rows("k string, v string", [("a", "1"), ("", "1"), (None, "1"), ("toolong", "1"), ("b", None)])
    assert table(clean.require_non_empty(df, ["k"], {"k": 3}), "k") == [("a",), ("b",)]
    assert table(clean.require_non_empty(df, ["k", "v"])) == [("a", "1"), ("toolong", "1")]


def test_network_keys_sort_and_return(rows):
    names = ["Wifi", "unknown", None, "", "GPRS", "2G", "3G", "4G", "CDMA2000-1x"]
    keys = column(rows, "n string", names, clean.rank_network("n"))
    assert keys == ["0WIFI", "-Unknown", "-Unknown", "-Unknown", "1GPRS", "2G", "3G", "4G", "CDMA2000"]
    assert sorted(set(keys)) == ["-Unknown", "0WIFI", "1GPRS", "2G", "3G", "4G", "CDMA2000"]
    assert column(rows, "n string", names, clean.rank_network("n", "sdk")) == [
        "1WIFI", "0Unknown", "0Unknown", "0Unknown", "0Unknown", "2G", "3G", "4G", "0Unknown"]
    assert column(rows, "n string", ["0WIFI", "-Unknown", "3G", "1GPRS"], clean.unrank_network("n")) == [
        "WIFI", "Unknown", "3G", "GPRS"]


def test_network_from_text(rows):
    texts = ["LTE 4G+3G", "3G", "WIFI-2G", "x WIFI", "other", None]
    assert column(rows, "n string", texts, clean.network_from_text("n")) == ["4G", "3G", "2G", "WIFI", "unknown", "unknown"]
    assert column(rows, "n string", texts, clean.network_from_text("n", exact=True)) == [None, "3G", None, None, None, None]


def test_flags_and_defaults(rows):
    df = rows("isroot string, gp string, havaapn string, path string, city string",
              [("1", "1", "1", "5", ""), ("0", None, "0", "9", None), (None, "2", None, "x", "c")])
    assert table(clean.normalize_flags(df).drop("city")) == [("1", "1", "1", "5"), ("2", "2", "0", "0"), ("2", "2", "0", "0")]
    assert table(clean.default_unknown(df, ["city"]), "city") == [("c",), ("unknown",), ("unknown",)]
    assert table(clean.default_unknown(df, ["city"], None), "city") == [("",), ("",), ("c",)]


def test_minutes_percent_seconds(rows):
    ms = [None, -5, 0, 59999, 60000, 90000, 7200000, 7200001]
    assert column(rows, "v long", ms, clean.bucket_minutes("v")) == [0, 0, 0, 1, 1, 2, 120, 121]
    pct = [None, -1, 0, 1, 100, 101]
    assert column(rows, "v int", pct, clean.clamp_percent("v")) == [0, 0, 0, 1, 100, 100]
    assert column(rows, "v int", pct, clean.clamp_percent("v", strict=True)) == [0, 0, 0, 1, 100, 0]
    assert column(rows, "v long", [None, 0, 1, 1000, 1001, 3599999, 3600000], clean.duration_seconds("v")) == [
        None, None, 1, 1, 2, 3600, None]
    assert column(rows, "v long", [0, 400, 1500, -2600], clean.session_seconds("v")) == [1, 1, 2, 3]


def test_isp_code(rows):
    imsi = ["460001234567", "46055999", "4600", "46a01xxx", "", None]
    assert column(rows, "v string", imsi, clean.isp_code("v")) == [46000, 46055, None, None, None, None]
    assert column(rows, "v string", imsi, clean.isp_code("v", known_only=True)) == [46000, 0, 0, 0, 0, 0]


def test_optional_column_and_labels(rows):
    df = rows("a int", [(1,), (None,)])
    assert table(clean.add_optional_column(df, "b", 0, "long")) == [("", "0"), ("1", "0")]
    assert table(clean.add_optional_column(df, "a", 7)) == [("1",), ("7",)]
    assert column(rows, "v int", [0, 1, 2, None], clean.label_codes("v", clean.CONTENT_TYPE, "其他")) == ["资讯", "视频", "其他", "其他"]


def test_dates(spark, rows):
    got = one(spark, i=dates.date_int(F.lit("2024-02-29").cast("date")), d=dates.date_from_int(F.lit(20240229)),
              bad=dates.date_from_int(F.lit(20240230)), t=dates.dashed(F.lit(20240102)),
              gap=dates.day_gap(F.lit("2024-03-01").cast("date"), F.lit("2024-02-28").cast("date")),
              s=dates.second_gap(F.lit("2024-01-01 00:01:00").cast("timestamp"), F.lit("2024-01-01").cast("timestamp")))
    assert (got.i, str(got.d), got.bad, got.t, got.gap, got.s) == (20240229, "2024-02-29", None, "2024-01-02", 2, 60)
    df = rows("k int, t timestamp", [(1, "2024-01-01 23:59:59"), (2, "2024-01-02"), (3, "2024-01-02 23:59:59.999"), (4, "2024-01-03")])
    assert table(df.where(dates.on_day("t", "2024-01-02")), "k") == [("2",), ("3",)]


def test_pairs_round_trip_and_bad_entries(spark):
    got = one(spark, p=packed.parse_pairs(F.lit("5:0.5, 7:1,bad,9:x,:2")), e=packed.parse_pairs(F.lit("")))
    assert [(p.tag, p.weight) for p in got.p] == [(5, 0.5), (7, 1.0)] and got.e == []
    back = one(spark, t=packed.format_pairs(packed.parse_pairs(F.lit("5:0.5,7:1.25"))))
    assert back.t == "5:0.5,7:1.25"


def test_explode_packed(rows):
    df = rows("k int, ads string", [(1, "a~r,b~s"), (2, ""), (3, None), (4, "c,,d~t")])
    assert table(packed.explode_packed(df, "ads", ("ad", "res"), inner="~"), "k", "ad", "res") == [
        ("1", "a", "r"), ("1", "b", "s"), ("4", "c", ""), ("4", "d", "t")]
    assert table(packed.explode_packed(df, "ads", "id"), "k", "id") == [("1", "a~r"), ("1", "b~s"), ("4", "c"), ("4", "d~t")]


def test_composite_id(spark):
    got = one(spark, c=packed.composite_id(F.lit(1), F.lit(123)), m=packed.composite_model(F.lit("2-5-6")), i=packed.composite_item(F.lit("1-77")))
    assert (got.c, got.m, got.i) == ("1-123", 2, 77)


V1, V2, V3 = {1: 1.31, 2: 1.03, 3: 0.53}, {1: 1.01, 4: 0.99, 5: 0.59}, {2: 1.35, 3: 0.98, 6: 0.37}


@pytest.mark.parametrize("a,b", [(V1, V2), (V1, V3), (V2, V3), (V1, V1), ({}, V1)])
def test_vectors(spark, a, b):
    shared = sorted(set(a) & set(b))
    dot = sum(a[k] * b[k] for k in shared)
    size = lambda v: math.sqrt(sum(x * x for x in v.values()))
    df = spark.createDataFrame([(a, b)], "a map<bigint,double>, b map<bigint,double>")
    got = df.select(vectors.dot("a", "b"), vectors.cosine("a", "b"), vectors.pearson("a", "b")).first()
    assert got[0] == pytest.approx(dot)
    assert got[1] == (pytest.approx(dot / (size(a) * size(b))) if a and b else None)
    n = len(shared)
    corr = 0.0
    if n:
        mx, my = sum(a[k] for k in shared) / n, sum(b[k] for k in shared) / n
        den = math.sqrt(sum((a[k] - mx) ** 2 for k in shared) * sum((b[k] - my) ** 2 for k in shared))
        corr = sum((a[k] - mx) * (b[k] - my) for k in shared) / den if den > 1e-12 else 0.0
    assert got[2] == pytest.approx(corr, abs=1e-6)


def test_dim_date(spark):
    d = {r.id: r for r in dims.dim_date(spark, "2023-12-31", "2024-01-01").collect()}
    sunday, monday = d[20231231], d[20240101]
    assert (sunday.week_day, sunday.week_of_year, sunday.half_year, sunday.quarter_name, sunday.cn_week_name) == (6, 52, 2, "Q4", "周日")
    assert (monday.week_day, monday.week_of_year, monday.order_no, monday.month_name, monday.cn_month_name, monday.abbr_week_name) == (
        0, 1, 20890520 - 20240101, "January", "一月", "Mon")


def test_dim_cohort(spark):
    c = {r.id: r for r in dims.dim_cohort(spark, 800).collect()}
    assert len(c) == 802 and c[-1].day_num == "未知" and c[-1].year_num == "未知"
    for i in (0, 6, 7, 364, 365, 729, 800):
        year, month = i // 365, min(i % 365 // 30, 11)
        assert [c[i].day_num, c[i].week_num, c[i].month_num, c[i].quarter_num, c[i].year_num] == [
            str(x) for x in (i + 1, i // 7 + 1, year * 12 + month + 1, year * 4 + month // 3 + 1, year + 1)]
    assert (c[0].times_1, c[2].times_1_desc, c[50].times_1_desc, c[2].times_3_desc, c[31].time_2_desc, c[1800].time_1_desc if 1800 in c else "10-30分") == (
        0, "1-2次", "50次+", "2次", "30~120分", "10-30分")


def test_constant_dimensions(spark):
    assert dims.dim_isp(spark).count() == 7
    assert table(dims.dim_product(spark, {"b": "B", "a": "A"})) == [("a", "A"), ("b", "B")]
