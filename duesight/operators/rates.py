"""One exchange rate per currency out of a dated rate history."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duesight.sources.tables import Tables


def _last_of_day(history: DataFrame) -> DataFrame:
    """Last entry of each currency and day."""
    return history.groupBy(F.col("from_currency_id").alias("currency_id"), "date").agg(F.max_by("value", "id").alias("value"))


def _newest(history: DataFrame) -> DataFrame:
    """Last entry of each currency's last day.

    Days come first: their buffers are plain numbers, so a long history is hashed on
    the map side and not sorted, and only currencies times days are left for the rest.
    """
    newest = F.max_by(F.struct("value", "date"), "date").alias("newest")
    return (
        _last_of_day(history)
        .groupBy("currency_id")
        .agg(newest)
        .select("currency_id", F.col("newest.value").alias("rate"), F.col("newest.date").alias("rate_date"))
    )


def latest_rate(history: DataFrame, as_of: dt.date) -> DataFrame:
    """Newest rate per currency; a currency whose newest rate lies in the future has none."""
    return _newest(history).filter(F.col("rate_date") <= F.lit(as_of))


def asof_rate(history: DataFrame, as_of: dt.date) -> DataFrame:
    """Newest rate per currency that was known on the as-of date."""
    return _newest(history.filter(F.col("date") <= F.lit(as_of)))


def rate_intervals(history: DataFrame) -> DataFrame:
    """Currency, rate, and the days it holds: from ``rate_date`` up to but not including ``next_date`` (null: for good)."""
    following = Window.partitionBy("currency_id").orderBy("rate_date")
    days = _last_of_day(history).filter("date is not null").withColumnsRenamed({"date": "rate_date", "value": "rate"})
    return days.withColumn("next_date", F.lead("rate_date").over(following))


def holding_on(intervals: DataFrame, days: DataFrame, since: str, until: str, bucket_days: int = 64) -> DataFrame:
    """Each of ``days`` (a column ``report_date``) with the rows of ``intervals`` that hold on it, in one job.

    An interval holds from ``since`` up to but not including ``until`` (null: for good). Intervals and days meet in buckets
    of days: an interval goes to each bucket it touches, inside the span of the days, and a day has one bucket. So
    both sides are joined by equal numbers, and only a bucket's own intervals are compared with a day.
    """
    wanted = days.select("report_date").filter("report_date is not null").distinct()
    span = wanted.agg(F.min("report_date").alias("first"), F.max("report_date").alias("last"))
    first, last = (span.select(name).scalar() for name in ("first", "last"))
    start, end = F.col(since), F.col(until)

    def bucket(day):
        return F.floor(F.unix_date(day) / bucket_days)

    inside = intervals.filter((start <= last) & F.coalesce(end > first, F.lit(True)))
    from_bucket = bucket(F.greatest(start, first))
    to_bucket = bucket(F.least(F.coalesce(F.date_sub(end, 1), last), last))
    touched = inside.withColumn("_bucket", F.explode(F.sequence(from_bucket, to_bucket)))
    met = wanted.withColumn("_bucket", bucket(F.col("report_date"))).join(touched, "_bucket")
    return met.filter((start <= F.col("report_date")) & F.coalesce(F.col("report_date") < end, F.lit(True))).drop("_bucket")


def asof_rate_by_day(history: DataFrame, days: DataFrame, bucket_days: int = 64) -> DataFrame:
    """The rate of every currency as it was known on each of ``days``."""
    held = holding_on(rate_intervals(history), days, "rate_date", "next_date", bucket_days)
    return held.select("report_date", "currency_id", "rate", "rate_date")


def currency_table(t: Tables, as_of: dt.date, corrected: bool = False) -> DataFrame:
    """Currency id -> code and rate of one run.

    ``corrected`` falls back to an older rate where the newest lies ahead.
    """
    pick = asof_rate if corrected else latest_rate
    rates = pick(t.forex_conversions, as_of).select("currency_id", "rate")
    currencies = t.currencies.withColumnRenamed("id", "currency_id")
    return currencies.join(rates, "currency_id", "full")
