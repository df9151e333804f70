"""Scalar rules on hand-made values: strict thresholds, NULL logic, labels."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from chartlake import config as C
from chartlake.functions import calendar as cal
from chartlake.functions import scalars as sc

L = C.Labels()


def one(spark, col, value, ddl):
    return spark.createDataFrame([(value,)], f"x {ddl}").select(col(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("hours,bucket", [
    (0.0, L.sun_dark), (3.99, L.sun_1_4), (4.0, L.sun_4_8), (7.99, L.sun_4_8),
    (8.0, L.sun_8_12), (11.99, L.sun_8_12), (12.0, L.sun_12), (None, L.sun_12),
])
def test_sunshine_bucket_edges_and_null(spark, hours, bucket):
    assert one(spark, lambda c: sc.sunshine_bucket(c), hours, "double") == bucket


def test_sunshine_bucket_null_option(spark):
    assert one(spark, lambda c: sc.sunshine_bucket(c, L, "unknown"), None, "double") == "unknown"


@pytest.mark.parametrize("a,label", [(0.7, L.hybrid), (0.70001, L.acoustic), (0.3, L.hybrid),
                                     (0.29999, L.electronic)])
def test_acoustic_type_strict(spark, a, label):
    assert one(spark, lambda c: sc.acoustic_type(c), a, "double") == label


def test_day_weather_rules(spark):
    rows = [(5.0, 9.0), (5.01, 0.0), (None, 8.0), (None, 8.01), (1.0, None)]
    df = spark.createDataFrame(rows, "p double, s double").select(sc.day_weather("p", "s").alias("w"))
    assert [r.w for r in df.collect()] == [L.sun, L.rain, None, L.sun, None]


def test_week_weather_rules(spark):
    rows = [(5.0, 12.0), (5.1, 20.0), (None, 12.5), (1.0, 8.0), (1.0, 8.5)]
    df = spark.createDataFrame(rows, "p double, s double").select(sc.week_weather("p", "s").alias("w"))
    assert [r.w for r in df.collect()] == [L.week_sunny, L.week_rain, L.week_very_sunny, None, L.week_sunny]


@pytest.mark.parametrize("n,label", [(1_000_000, "1000.0K"), (1_000_001, "1.0M"), (2_999_999, "2.0M"),
                                     (999, "0.0K"), (0, "0.0K"), (123_456_789, "123.0M")])
def test_compact_count_truncates_and_strict_boundary(spark, n, label):
    assert one(spark, sc.compact_count, n, "bigint") == label


@pytest.mark.parametrize("cur,prev,pct", [(1.1, 1.0, 10.000000000000009), (1.0, 0.0, 0.0), (1.0, None, 0.0)])
def test_change_pct(spark, cur, prev, pct):
    df = spark.createDataFrame([(cur, prev)], "c double, p double")
    assert df.select(sc.change_pct("c", "p").alias("x")).first().x == pytest.approx(pct)


def test_trend_label(spark):
    df = spark.createDataFrame([(0.004,), (-0.004,), (0.005,), (-0.2,), (None,)], "d double")
    got = [r.t for r in df.select(sc.trend_label("d", 0.005).alias("t")).collect()]
    assert got == [L.flat, L.flat, L.up, L.down, None]


@pytest.mark.parametrize("text,root", [
    ('[{"root":"Pop"}]', "Pop"), ('[{"root":"A"},{"root":"B"}]', "A"), ("[]", None), ("not json", None),
    (None, None), ('[{"other":"x"}]', ""), ('[{"root":null}]', ""),
])
def test_genre_root(spark, text, root):
    assert one(spark, sc.genre_root, text, "string") == root


@pytest.mark.parametrize("key,mode,name", [(0, 1, "C"), (1, 0, "C#m"), (11, 0, "Bm"), (12, 1, None), (0, 2, "C"),
                                           (None, 1, None)])
def test_note_name(spark, key, mode, name):
    df = spark.createDataFrame([(key, mode)], "k int, m int")
    assert df.select(sc.note_name("k", "m").alias("n")).first().n == name


def test_seconds_conversions(spark):
    df = spark.createDataFrame([(0.0, 1.9999), (7200.0, -1.5), (None, None)], "s double, d double")
    rows = df.select(sc.seconds_to_hours("s").alias("h"), sc.seconds_to_ms("d").alias("ms")).collect()
    assert [(r.h, r.ms) for r in rows] == [(None, 1999), (2.0, -1500), (None, None)]


def test_nullable_int_lenient(spark):
    df = spark.createDataFrame([("7",), ("x",), (None,)], "v string")
    assert [r.i for r in df.select(sc.nullable_int("v").alias("i")).collect()] == [7, None, None]


def test_seasons_and_keys(spark):
    df = spark.createDataFrame([(m,) for m in range(1, 13)], "m int")
    got = [r.s for r in df.select(cal.season("m").alias("s")).collect()]
    assert got == [L.winter, L.winter] + [L.spring] * 3 + [L.summer] * 3 + [L.autumn] * 3 + [L.winter]
    d = spark.createDataFrame([(dt.date(2024, 1, 7),)], "d date")
    r = d.select(cal.date_key("d").alias("k"), cal.is_sunday("d").alias("sun")).first()
    assert r.k == 20240107 and r.sun is True


@pytest.mark.parametrize("day,first,last", [
    (dt.date(2020, 1, 1), dt.date(2020, 1, 5), dt.date(2019, 12, 29)),
    (dt.date(2020, 1, 5), dt.date(2020, 1, 5), dt.date(2020, 1, 5)),
    (dt.date(2026, 2, 14), dt.date(2026, 2, 15), dt.date(2026, 2, 8)),
])
def test_sunday_bounds(spark, day, first, last):
    df = spark.createDataFrame([(day,)], "d date")
    r = df.select(cal.first_sunday_on_or_after("d").alias("f"), cal.last_sunday_on_or_before("d").alias("l"),
                  cal.sunday_on_or_after("d").alias("f2")).first()
    assert (r.f, r.l, r.f2) == (first, last, first)


def test_api_date_parse_and_labels(spark):
    df = spark.createDataFrame([("2024-01-07T00:00:00+00:00",)], "s string")
    r = df.select(cal.parse_api_date("s").alias("d")).select(
        "d", cal.day_month_label("d").alias("a"), cal.day_month_year_label("d").alias("b"),
        cal.api_noon_label("d").alias("c")).first()
    assert r.d == dt.date(2024, 1, 7) and r.a == "07.01" and r.b == "07.01.2024"
    assert r.c == "2024-01-07T12:00:00+00:00"


def test_percent_of_guarded(spark):
    df = spark.createDataFrame([(1, 4), (1, 0), (None, 2)], "a int, b int")
    assert [r.p for r in df.select(sc.percent_of("a", "b").alias("p")).collect()] == [25.0, None, None]


@pytest.mark.parametrize("value, digits, label", [
    (0.25, 1, "0.2"), (0.35, 1, "0.3"), (1234567.0, 0, "1,234,567"), (0.5, 0, "0"), (1.5, 0, "2"), (-1234.567, 2, "-1,234.57"), (None, 1, None)])
def test_number_label(spark, value, digits, label):
    df = spark.createDataFrame([(value,)], "x double")
    assert df.select(sc.number_label("x", digits)).first()[0] == label
    assert label is None or label == f"{value:,.{digits}f}"
