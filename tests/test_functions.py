import datetime as dt
import random

from pyspark.sql import functions as F

from basketry.functions import dates, labels, money
from tests.conftest import ts


def one(spark, **columns):
    return spark.range(1).select(*(c.alias(n) for n, c in columns.items())).first().asDict()


def day(text):
    return F.lit(dt.date.fromisoformat(text))


def test_month_boundaries(spark):
    got = one(
        spark,
        next_day=dates.month_boundaries(day("2024-01-31"), day("2024-02-01")),
        same_month=dates.month_boundaries(day("2024-01-01"), day("2024-01-31")),
        before=dates.month_boundaries(day("2024-01-01"), day("2023-12-31")),
        over_year=dates.month_boundaries(day("2022-11-15"), day("2024-02-01")),
    )
    assert got == {"next_day": 1, "same_month": 0, "before": -1, "over_year": 15}


def test_second_boundaries(spark):
    start, end = F.lit(ts("2024-01-01 00:00:00.900")), F.lit(ts("2024-01-01 00:00:01.100"))
    got = one(spark, up=dates.second_boundaries(start, end), down=dates.second_boundaries(end, start))
    assert got == {"up": 1, "down": -1}


def test_trailing_windows(spark):
    as_of = day("2024-03-31")
    got = one(
        spark,
        on_edge=dates.in_last_days(day("2024-03-01"), as_of, 30),
        before_edge=dates.in_last_days(day("2024-02-29"), as_of, 30),
        later=dates.in_last_days(day("2024-04-02"), as_of, 30),
        clamped=dates.in_last_months(day("2024-02-29"), as_of, 1),
        before_clamped=dates.in_last_months(day("2024-02-28"), as_of, 1),
        whole=dates.in_last_months(day("2024-02-01"), as_of, 2, whole_months=True),
        before_whole=dates.in_last_months(day("2024-01-31"), as_of, 2, whole_months=True),
    )
    assert got == {
        "on_edge": True, "before_edge": False, "later": True, "clamped": True, "before_clamped": False,
        "whole": True, "before_whole": False,
    }


def test_as_of_forms(spark):
    got = one(spark, text=dates.as_of_date("2024-05-01"), date=dates.as_of_date(dt.date(2024, 5, 1)), today=dates.as_of_date(None))
    assert got["text"] == got["date"] == dt.date(2024, 5, 1)
    assert abs((got["today"] - dt.date.today()).days) <= 1


def test_calendar_labels(spark):
    moment = F.lit(ts("2024-02-29 23:59:59"))
    got = one(
        spark, weekday=dates.weekday_name(moment), month=dates.year_month(moment),
        start=dates.month_start(moment.cast("date")),
    )
    assert got == {"weekday": "Thursday", "month": "2024-02", "start": dt.date(2024, 2, 1)}


def test_weekday_names_follow_the_calendar(spark):
    week = spark.range(7).select(F.date_add(day("2024-07-01"), F.col("id").cast("int")).alias("d"))
    named = week.select("d", dates.weekday_name(F.col("d")).alias("name")).collect()
    assert [r["name"] for r in named] == [r["d"].strftime("%A") for r in named]


def test_exact_sum_ignores_row_order(spark):
    values = [round(random.Random(7).uniform(-1e6, 1e6), 2) for _ in range(1)] + [0.1, 0.2, 0.3, 1e9, -1e9] * 200
    total = lambda v: spark.createDataFrame([(x,) for x in v], "x double").agg(money.exact_sum(F.col("x"))).first()[0]
    assert total(values) == total(values[::-1]) == round(sum(map(lambda x: round(x * 100), values)) / 100, 2)


def test_sums_of_nothing_are_null(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert tuple(df.agg(money.exact_sum(F.col("x")), money.exact_avg(F.col("x"))).first()) == (None, None)


def test_average_skips_nulls(spark):
    df = spark.createDataFrame([(1.0,), (None,), (2.5,)], "x double")
    assert df.agg(money.exact_avg(F.col("x"))).first()[0] == 1.75


def test_rounding_and_percent(spark):
    got = one(
        spark, up=money.round_half_away(F.lit(0.125)), down=money.round_half_away(F.lit(-0.125)),
        nothing=money.round_half_away(F.lit(None).cast("double")),
        third=money.percent(F.lit(1), F.lit(3)), zero=money.percent(F.lit(1), F.lit(0)),
    )
    assert got == {"up": 0.13, "down": -0.13, "nothing": None, "third": 100.0 / 3, "zero": None}


def test_labels(spark):
    df = spark.createDataFrame([("DELIVERED",), ("REFUNDED",), (None,)], "s string")
    got = [tuple(r) for r in df.select(labels.label(F.col("s"), labels.STATUS_LABELS), labels.label(F.col("s"), labels.DOMAIN_STATUS_LABELS)).collect()]
    assert got == [("Completed", "Completed"), ("Unknown", "Returned"), ("Unknown", "Unknown")]


def test_margin_classes(spark):
    df = spark.createDataFrame([(0.5,), (0.4999,), (0.25,), (0.24,), (None,)], "r double")
    assert [r[0] for r in df.select(labels.margin_class(F.col("r"))).collect()] == ["High", "Medium", "Medium", "Low", "Low"]
