"""Due dates, month offsets, ageing buckets and their labels."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bucket names. Future months are p1, p2, ...
PAST = "past"
RECENT = {-3: "m-3", -2: "m-2", -1: "m-1"}
CURRENT_DUE = "current_due"
CURRENT_NOT_DUE = "current_not_due"
UNPLACED = "unplaced"
FIXED_BUCKETS = (PAST, *RECENT.values(), CURRENT_DUE, CURRENT_NOT_DUE)
DUE_BUCKETS = (PAST, *RECENT.values(), CURRENT_DUE)



def _text(pattern: str):
    return lambda moment: F.date_format(moment, pattern)


def _twelve_hours(moment: Column) -> Column:
    return (F.hour(moment) + 11) % 12 + 1


def _iso_year(moment: Column) -> Column:
    """Year of the Thursday of the week."""
    return F.year(F.date_add(F.to_date(moment), 3 - (F.dayofweek(moment) + 5) % 7))


def _week_from_sunday(moment: Column) -> Column:
    """0 to 53; week 1 begins with the first Sunday."""
    return F.floor((F.dayofyear(moment) + 7 - F.dayofweek(moment)) / 7).cast("int")


def _before_first_sunday(moment: Column) -> Column:
    return F.date_add(F.trunc(F.to_date(moment), "year"), -1)


def _week_from_monday(moment: Column) -> Column:
    """0 to 53; week 1 has four days of the year or more."""
    day, year = F.to_date(moment), _iso_year(moment)
    return (
        F.when(year < F.year(moment), 0)
        .when(year > F.year(moment), F.weekofyear(F.date_add(day, -7)) + 1)
        .otherwise(F.weekofyear(moment))
    )


def _day_with_suffix(moment: Column) -> Column:
    day = F.dayofmonth(moment)
    ending = F.when(day.between(11, 13), "th").when(day % 10 == 1, "st").when(day % 10 == 2, "nd").when(day % 10 == 3, "rd")
    return F.concat(day.cast("string"), ending.otherwise("th"))


# The letters of FROM_UNIXTIME's format, as numbers where they are digits.
DATE_PARTS = {
    "Y": F.year,
    "y": lambda moment: F.year(moment) % 100,
    "m": F.month,
    "c": F.month,
    "M": _text("MMMM"),
    "b": _text("MMM"),
    "d": F.dayofmonth,
    "e": F.dayofmonth,
    "D": _day_with_suffix,
    "j": F.dayofyear,
    "H": F.hour,
    "k": F.hour,
    "h": _twelve_hours,
    "I": _twelve_hours,
    "l": _twelve_hours,
    "i": F.minute,
    "s": F.second,
    "S": F.second,
    "f": lambda moment: F.lit(0),
    "p": _text("a"),
    "r": _text("hh:mm:ss a"),
    "T": _text("HH:mm:ss"),
    "w": lambda moment: weekday_from_sunday(moment),
    "W": _text("EEEE"),
    "a": _text("EEE"),
    "U": _week_from_sunday,
    "u": _week_from_monday,
    "V": lambda moment: F.when(_week_from_sunday(moment) > 0, _week_from_sunday(moment)).otherwise(
        _week_from_sunday(_before_first_sunday(moment))
    ),
    "v": F.weekofyear,
    "X": lambda moment: F.year(moment) - F.when(_week_from_sunday(moment) > 0, 0).otherwise(1),
    "x": _iso_year,
    "%": lambda moment: F.lit("%"),
}


def due_date(invoice_date: Column, credit_days: Column) -> Column:
    return F.date_add(invoice_date, credit_days)


def days_past_due(due: Column, as_of: dt.date) -> Column:
    return F.datediff(F.lit(as_of), due)


def month_offset(due: Column, as_of: dt.date) -> Column:
    """Whole calendar months from the as-of month to the due month."""
    return F.year(due) * 12 + F.month(due) - F.lit(as_of.year * 12 + as_of.month)


def bucket_name(offset: Column, overdue: Column) -> Column:
    """Bucket of a month offset; ``overdue`` splits the current month. No offset, no bucket."""
    bucket = F.when(offset.isNull(), UNPLACED).when(offset < min(RECENT), PAST)
    for months, name in RECENT.items():
        bucket = bucket.when(offset == months, name)
    return (
        bucket.when((offset == 0) & overdue, CURRENT_DUE)
        .when(offset == 0, CURRENT_NOT_DUE)
        .otherwise(F.concat(F.lit("p"), offset.cast("string")))
    )


def ageing_bucket(due: Column, as_of: dt.date) -> Column:
    """Bucket of a due date; a document without one stays unplaced."""
    return bucket_name(month_offset(due, as_of), due < F.lit(as_of))


def month_start(as_of: dt.date, offset: int) -> dt.date:
    index = as_of.year * 12 + as_of.month - 1 + offset
    return dt.date(index // 12, index % 12 + 1, 1)


def month_label(offset: Column, as_of: dt.date) -> Column:
    """``Jul-01`` style label of the month ``offset`` months from the as-of month."""
    return F.date_format(F.add_months(F.lit(month_start(as_of, 0)), offset), "MMM-yy")


def bucket_label(bucket: Column, offset: Column, as_of: dt.date) -> Column:
    prior = F.concat(F.lit("Prior to "), month_label(F.lit(min(RECENT)), as_of))
    return F.when(bucket == PAST, prior).otherwise(month_label(offset, as_of))


def day_text(day: Column) -> Column:
    return F.date_format(day, "dd-MMM-yyyy")


def month_text(day: Column) -> Column:
    return F.date_format(day, "MMM-yyyy")


def epoch_part(epoch_seconds: Column, part: str) -> Column:
    """One date part (``d``, ``H``, …) of an epoch column, in the session time zone."""
    if part not in DATE_PARTS:
        raise ValueError(f"no date part {part!r}; there are {' '.join(DATE_PARTS)}")
    return DATE_PARTS[part](F.timestamp_seconds(epoch_seconds))


def weekday_from_sunday(day: Column) -> Column:
    """0 = Sunday … 6 = Saturday."""
    return F.dayofweek(day) - 1
