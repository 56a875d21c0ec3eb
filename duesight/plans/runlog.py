"""Which jobs are due, how their last run went, and the rows a run leaves behind.

The log is append-only: a run writes one row when it starts and one when it ends,
and its state is its latest row. Nothing is updated in place.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duesight.functions.dates import epoch_part, weekday_from_sunday
from duesight.functions.text import strip_tags
from duesight.operators.lookup import all_of
from duesight.sources.tables import Tables

RUNNING, DONE, FAILED = None, 1, 0


def _planned(now: dt.datetime) -> Column:
    """Epoch seconds of a schedule's hour and minute on the day of ``now``."""
    midnight = int(now.replace(hour=0, minute=0, second=0, microsecond=0, tzinfo=dt.UTC).timestamp())
    return F.lit(midnight + now.second).cast("long") + F.col("hour") * 3600 + F.col("minute") * 60


def due_schedules(t: Tables, now: dt.datetime) -> DataFrame:
    """Per job the schedule still ahead today; the last one entered wins."""
    minute_of_day = F.col("hour") * 60 + F.col("minute")
    today = F.col("dayofweek") == weekday_from_sunday(F.lit(now.date()))
    ahead = minute_of_day >= now.hour * 60 + now.minute
    last = F.max_by(F.struct("id", "hour", "minute"), "id")
    return (
        t.schedules.filter((F.col("status") == 1) & today & ahead)
        .groupBy("name")
        .agg(last.alias("last"))
        .select("name", F.col("last.id").alias("schedule_id"), "last.hour", "last.minute")
        .withColumn("planned_ts", _planned(now))
    )


def latest_run(
    t: Tables,
    schedule_id: int | None = None,
    since: dt.date | None = None,
    parts: Mapping[str, int] | None = None,
) -> DataFrame:
    """Latest run of each schedule, among those that meet the conditions given.

    ``since`` keeps runs planned on or after that day; ``parts`` compares parts of
    the planned time, such as ``{"d": 7, "H": 9}``. On a log of ``store_by_day`` only the folders from ``since`` on are read.
    """
    predicates = []
    if schedule_id is not None:
        predicates.append(F.col("schedule_id") == schedule_id)
    if since is not None:
        midnight = dt.datetime(since.year, since.month, since.day, tzinfo=dt.UTC)
        predicates.append(F.col("date_cron") >= int(midnight.timestamp()))
        if "day" in t.scheduler_logs.columns:
            predicates.append(F.col("day") >= F.lit(since))
    for part, value in (parts or {}).items():
        predicates.append(epoch_part(F.col("date_cron"), part) == value)
    runs = t.scheduler_logs.filter(all_of(predicates))
    # Numbers only, so that the log is hashed: the last moment of each schedule, then its last id. The text
    # of the winners is fetched by id.
    moments = runs.groupBy("schedule_id", "date_runned").agg(F.max("id").alias("id"))
    last = moments.groupBy("schedule_id").agg(F.max_by("id", "date_runned").alias("id"))
    known = last.filter("id is not null")
    return runs.join(known, ["schedule_id", "id"]).select("schedule_id", "id", "log", "status", "date_runned", "date_cron")


def store_by_day(logs: DataFrame, folder: str) -> DataFrame:
    """The log of scheduled runs with a folder for each planned day, read back; a new day is added by writing it there."""
    day = F.to_date(F.timestamp_seconds("date_cron"))
    logs.withColumn("day", day).repartition("day", F.pmod("id", F.lit(8))).write.mode("append").partitionBy("day").parquet(folder)
    kinds = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in logs.schema)
    return logs.sparkSession.read.schema(f"{kinds}, day date").parquet(folder)


def start_events(due: DataFrame, now: dt.datetime) -> DataFrame:
    """The row a run appends when it starts. Schedule and planned time name the run."""
    started = int(now.replace(tzinfo=dt.UTC).timestamp())
    return due.select(
        F.concat_ws("-", "schedule_id", "planned_ts").alias("run_id"),
        "schedule_id",
        F.lit(started).cast("long").alias("event_ts"),
        "planned_ts",
        F.lit(RUNNING).cast("int").alias("status"),
        F.lit("").alias("message"),
    )


def end_events(starts: DataFrame, now: dt.datetime, status: int, message: str = "") -> DataFrame:
    """The row a run appends when it ends."""
    ended = int(now.replace(tzinfo=dt.UTC).timestamp())
    return (
        starts.withColumn("event_ts", F.lit(ended).cast("long"))
        .withColumn("status", F.lit(status))
        .withColumn("message", strip_tags(F.lit(message)))
    )


def run_state(events: DataFrame) -> DataFrame:
    """Current state of every run: its latest event."""
    return merge_states(events.withColumn("started_ts", F.col("event_ts")))


def merge_states(rows: DataFrame) -> DataFrame:
    """Current state of every run out of events and of states that were merged before.

    A state is an event with ``started_ts``, the moment of the run's first event; of an event that is its own.
    """
    # Moments are numbers and hashed; only the events of a run's last moment are compared as text.
    moments = rows.groupBy("run_id").agg(F.min("started_ts").alias("started_ts"), F.max("event_ts").alias("event_ts"))
    last = rows.drop("started_ts").join(moments, ["run_id", "event_ts"])
    latest = F.max(F.struct("status", "message", "schedule_id", "planned_ts")).alias("latest")
    return (
        last.groupBy("run_id", "started_ts", "event_ts")
        .agg(latest)
        .select("run_id", "started_ts", "event_ts", "latest.schedule_id", "latest.planned_ts", "latest.status", "latest.message")
    )
