"""The run log as a snapshot of latest states and the events that came after it.

Events are appended to folders by day. ``compact`` folds all days up to one into a snapshot with one row per run and switches to
it by a manifest. Reading takes the snapshot and the folders of later days, so it costs what is new and not what was
ever logged. A crash before the switch leaves the old snapshot and all events; files of the attempt are never read.

An event that arrives for a day that is already in the snapshot goes into the first open day, so nothing is passed
over. A day that is being compacted must not be appended to at the same time.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duesight.plans.runlog import merge_states
from duesight.sources.manifest import Manifests
from duesight.sources.schemas import RUN_EVENT_SCHEMA

STATE_SCHEMA = f"{RUN_EVENT_SCHEMA}, started_ts long"


class RunLog:
    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder.rstrip("/")
        self._manifests = Manifests(spark, folder)

    def _state(self) -> dict:
        return self._manifests.latest()[1] or {"snapshot": None, "through": None}

    def append(self, events: DataFrame) -> None:
        """Add events; earlier rows are never touched."""
        through = self._state()["through"]
        day = F.to_date(F.timestamp_seconds("event_ts"))
        if through is not None:
            day = F.greatest(day, F.lit(dt.date.fromisoformat(through) + dt.timedelta(days=1)))
        # Rows of a day meet in few files, whatever the tasks held.
        dealt = events.withColumn("day", day).repartition("day", F.pmod(F.xxhash64("run_id"), F.lit(8)))
        dealt.write.mode("append").partitionBy("day").parquet(f"{self._folder}/events")

    def events(self, since: dt.date | None = None, after: dt.date | None = None, until: dt.date | None = None) -> DataFrame:
        """Events whose folder lies in the span; other folders are not listed as files to read. ``since`` also
        leaves out single events before that day."""
        if not self._manifests.has("events"):
            return self._spark.createDataFrame([], f"{RUN_EVENT_SCHEMA}, day date")
        rows = self._spark.read.schema(f"{RUN_EVENT_SCHEMA}, day date").parquet(f"{self._folder}/events")
        if since is not None:
            midnight = dt.datetime(since.year, since.month, since.day, tzinfo=dt.UTC)
            rows = rows.filter((F.col("day") >= F.lit(since)) & (F.col("event_ts") >= int(midnight.timestamp())))
        if after is not None:
            rows = rows.filter(F.col("day") > F.lit(after))
        if until is not None:
            rows = rows.filter(F.col("day") <= F.lit(until))
        return rows

    def _merged(self, until: dt.date | None = None) -> DataFrame:
        state = self._state()
        through = dt.date.fromisoformat(state["through"]) if state["through"] else None
        tail = self.events(after=through, until=until).withColumn("started_ts", F.col("event_ts")).drop("day")
        if state["snapshot"] is None:
            return merge_states(tail)
        snapshot = self._spark.read.schema(STATE_SCHEMA).parquet(f"{self._folder}/{state['snapshot']}")
        return merge_states(snapshot.unionByName(tail))

    def states(self) -> DataFrame:
        """Current state of every run: its latest event, and when it started."""
        return self._merged()

    def write_snapshot(self, through: dt.date) -> dict:
        """First half of ``compact``: states of all days up to ``through`` in a folder nothing refers to yet."""
        name = f"snapshots/{uuid.uuid4().hex}"
        self._merged(until=through).write.parquet(f"{self._folder}/{name}")
        return {"snapshot": name, "through": through.isoformat()}

    def compact(self, through: dt.date) -> None:
        """Fold all days up to ``through`` into a new snapshot and switch to it."""
        number, state = self._manifests.latest()
        if state and state["through"] and dt.date.fromisoformat(state["through"]) >= through:
            return
        self._manifests.publish(number, self.write_snapshot(through))

    def sweep(self) -> None:
        """Delete snapshots that are not the current one; events stay."""
        self._manifests.sweep("snapshots", {self._state()["snapshot"]})
