"""Column expressions at their edges."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from duesight.functions import dates, text
from tests.conftest import AS_OF


def test_format_money(spark):
    rows = [
        ("1234567.50", "INR", "12,34,568"),
        ("1234567.50", "USD", "1,234,568"),
        ("1234567.50", None, "1,234,568"),
        ("-1234.00", "INR", "(1,234)"),
        ("0.40", "USD", ""),
        ("-0.40", "USD", "(0)"),
        (None, "USD", ""),
        ("0.50", "USD", "1"),
        ("2.50", "USD", "3"),
        ("999.00", "INR", "999"),
        ("100000.00", "INR", "1,00,000"),
        ("100000.00", "EUR", "100,000"),
        ("12345678901234.00", "INR", "1,23,45,67,89,01,234"),
    ]
    frame = spark.createDataFrame(rows, "value string, currency string, expected string")
    actual = frame.select(
        "expected", text.format_money(F.col("value").cast("decimal(18,2)"), F.col("currency")).alias("actual")
    )
    for row in actual.collect():
        assert row.actual == row.expected


@pytest.mark.parametrize(
    "as_of, due, offset, bucket",
    [
        ("2001-06-15", None, None, "unplaced"),
        ("2001-06-15", "2001-02-28", -4, "past"),
        ("2001-06-15", "2001-03-01", -3, "m-3"),
        ("2001-06-15", "2001-05-31", -1, "m-1"),
        ("2001-06-15", "2001-06-01", 0, "current_due"),
        ("2001-06-15", "2001-06-14", 0, "current_due"),
        ("2001-06-15", "2001-06-15", 0, "current_not_due"),
        ("2001-06-15", "2001-06-30", 0, "current_not_due"),
        ("2001-06-15", "2001-07-01", 1, "p1"),
        ("2001-06-15", "2002-06-30", 12, "p12"),
        ("2001-06-01", "2001-05-31", -1, "m-1"),
        ("2001-02-10", "2001-02-28", 0, "current_not_due"),
        ("2001-03-31", "2001-03-30", 0, "current_due"),
        ("2001-03-31", "2000-12-31", -3, "m-3"),
        ("2001-01-31", "2000-09-30", -4, "past"),
    ],
)
def test_ageing_bucket(spark, as_of, due, offset, bucket):
    day = dt.date.fromisoformat(as_of)
    column = F.lit(due).cast("date")
    row = spark.range(1).select(dates.month_offset(column, day), dates.ageing_bucket(column, day)).first()
    assert tuple(row) == (offset, bucket)


def test_labels_do_not_slip_at_month_end(spark):
    day = dt.date(2001, 3, 31)
    row = spark.range(1).select(
        dates.month_label(F.lit(-1), day),
        dates.bucket_label(F.lit("past"), F.lit(-4), day),
        dates.day_text(F.lit(day)),
        dates.month_text(F.lit(day)),
    )
    assert tuple(row.first()) == ("Feb-01", "Prior to Dec-00", "31-Mar-2001", "Mar-2001")


def test_weekday_and_epoch_parts(spark):
    moment = F.lit(int(dt.datetime(2001, 6, 17, 9, 5, tzinfo=dt.UTC).timestamp()))
    row = spark.range(1).select(
        dates.weekday_from_sunday(F.lit(dt.date(2001, 6, 17))),
        *[dates.epoch_part(moment, part) for part in ("d", "H", "i", "m", "Y", "w", "j")],
    )
    assert tuple(row.first()) == (0, 17, 9, 5, 6, 2001, 0, 168)


def test_every_letter_of_the_database_format(spark):
    """Two days that weeks count differently: a Sunday, and a Monday in next year's first ISO week."""
    sunday = F.lit(int(dt.datetime(2001, 6, 3, 0, 5, 7, tzinfo=dt.UTC).timestamp()))
    monday = F.lit(int(dt.datetime(2001, 12, 31, 13, 5, 7, tzinfo=dt.UTC).timestamp()))
    want = {
        "y": (1, 1), "M": ("June", "December"), "b": ("Jun", "Dec"), "D": ("3rd", "31st"), "h": (12, 1), "l": (12, 1), "k": (0, 13),
        "f": (0, 0), "p": ("AM", "PM"), "r": ("12:05:07 AM", "01:05:07 PM"), "T": ("00:05:07", "13:05:07"), "W": ("Sunday", "Monday"),
        "a": ("Sun", "Mon"), "U": (22, 52), "u": (22, 53), "V": (22, 52), "v": (22, 1), "X": (2001, 2001), "x": (2001, 2002), "%": ("%", "%"),
    }
    row = spark.range(1).select(*[dates.epoch_part(moment, part) for part in want for moment in (sunday, monday)]).first()
    assert dict(zip(want, zip(row[::2], row[1::2], strict=True), strict=True)) == want
    with pytest.raises(ValueError, match="no date part 'Q'"):
        dates.epoch_part(sunday, "Q")


def test_names(spark):
    row = spark.range(1).select(
        text.person_name(F.lit("A"), F.lit(None).cast("string")),
        text.code_and_name(F.lit("C1"), F.lit("Name")),
        text.report_file_name(F.lit("Ann van Lee"), AS_OF),
        text.credit_text(F.lit(2).cast("decimal(18,2)")),
    )
    assert tuple(row.first()) == (None, "C1 - Name", "debtors_report_Ann_van_Lee_15-Jun-2001", "(2.00)")


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("plain", "plain"),
        ("<p class='a>b'>x</p> y", "x y"),
        ('a <a href="?x>1">link</a><br/>b', "a linkb"),
        ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"),
        ("a<!-- <b> comment > -->b", "ab"),
        ("line\n<i\nid=1>two</i>", "line\ntwo"),
        ("<" + "a" * 50000 + ">end", "end"),
        ("<a " + "x='1' " * 20000 + ">end", "end"),
        ('x <a href="q', "x "),
        ("a <!-- open <b>", "a "),
        ("<p>a</p><img src='", "a"),
        ("<!--" * 200_000, ""),
        ("<" * 200_000, "<" * 200_000),
    ],
)
def test_strip_tags(spark, raw, expected):
    frame = spark.createDataFrame([(raw,)], "raw string")
    assert frame.select(text.strip_tags(F.col("raw"))).first()[0] == expected
