"""Writers for sheets, summaries, logs and the outbox."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from duesight.plans.detail_sheet import SHEET_HEADINGS, SORT_COLUMNS
from duesight.plans.summary import CUSTOMER_KEY
from duesight.session import Stored, shuffles_dropped
from duesight.sources.manifest import Conflict, Manifests

ROWS_PER_FILE = 1_000_000
# Rows a task writes at least, however small the files are: what each task reports to the driver is not a matter of files.
ROWS_PER_TASK = 250_000
# Rows from which a sheet is dealt in one more pass, and most passes: disk holds what one of them shuffles.
ROWS_PER_PASS, PASSES = 4_000_000, 4
# Leading characters of the document key that a day with too many rows is cut by.
CUT = 6
PART_SCHEMA = "bdm_id long, part long, rows long, first_date date, first_key string, last_date date, last_key string"


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows of an owner with ``_day`` and ``_start``: what files are cut by."""
    day = F.coalesce(F.unix_date("sort_date"), F.lit(-(2**31)))
    return rows.filter(F.col("bdm_id").isNotNull()).withColumn("_day", day).withColumn("_start", F.substring("doc_key", 1, CUT))


def part_list(rows: DataFrame, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """One row for each file of the sheet ``rows``: owner, part, number of rows, dates and keys of the first and the last row.

    Rows are counted exactly by owner, day and leading characters of the document key. The part of a day (from 0) is the
    number of the owner's rows before it by ``rows_per_file``; in a day with more rows than a file holds, of those before the
    leading characters. So the parts follow one another in the order of dates and keys. Windows run over counts: the days of an
    owner, the beginnings of keys of a day.
    """
    at = F.struct("sort_date", "doc_key")
    starts = _keyed(rows).groupBy("bdm_id", "_day", "_start").agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("low"), F.max(at).alias("high"))

    def earlier(group: Sequence[str], order: str) -> Column:
        window = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("n").over(window), F.lit(0))

    inside = starts.withColumn("_inside", earlier(["bdm_id", "_day"], "_start"))
    days = starts.groupBy("bdm_id", "_day").agg(F.sum("n").alias("n"))
    days = days.select("bdm_id", "_day", earlier(["bdm_id"], "_day").alias("_before"), (F.col("n") > rows_per_file).alias("_crowded"))
    before = F.col("_before") + F.when(F.col("_crowded"), F.col("_inside")).otherwise(0)
    placed = inside.join(days, ["bdm_id", "_day"]).withColumn("part", F.floor(before / rows_per_file))
    files = placed.groupBy("bdm_id", "part").agg(F.sum("n").alias("rows"), F.min("low").alias("low"), F.max("high").alias("high"))
    return files.select(
        "bdm_id", "part", "rows", F.col("low.sort_date").alias("first_date"), F.col("low.doc_key").alias("first_key"),
        F.col("high.sort_date").alias("last_date"), F.col("high.doc_key").alias("last_key"),
    )


def _key() -> Column:
    """Owner, day and beginning of a keyed row as one text, in the same order; what is missing comes first."""
    owner = F.lpad(F.hex(F.col("bdm_id").cast("long").bitwiseXOR(F.lit(-(2**63)))), 16, "0")
    day = F.lpad(F.hex(F.col("_day").cast("long") + 2**31), 8, "0")
    return F.concat(owner, day, F.coalesce(F.concat(F.lit("1"), "_start"), F.lit("0")))


def _beginnings(value: str) -> list[Column]:
    """Aggregates: the sorted ``_keys`` at which something begins, and the ``_values`` of what begins there."""
    both = F.sort_array(F.collect_list(F.struct("_key", value)))
    return [both["_key"].alias("_keys"), both[value].alias("_values")]


def _placed(rows: DataFrame, most: int, name: str) -> DataFrame:
    """Rows with ``name``: of their ``_keys`` (``most`` at most), the value of the last that their own key reaches. It is found by
    halving, a column for each step, so that code is generated for it and the lists are never copied."""
    found, at = rows.withColumn("_key", _key()).withColumn("_at", F.lit(0)), F.col("_at")
    for k in reversed(range(max(1, most.bit_length()))):
        found = found.withColumn("_at", F.when(F.get("_keys", at + (1 << k)) <= F.col("_key"), at + (1 << k)).otherwise(at))
    # Never null for Spark, too: a join's filter for nulls would work out all steps once more, nested in each other.
    return found.withColumn(name, F.coalesce(F.get("_values", at), F.lit(-1))).drop("_keys", "_values", "_key", "_at")


def _in_files(rows: DataFrame, files: DataFrame, rows_per_file: int) -> Iterator[DataFrame]:
    """Rows with ``part`` in the order of owner, date and document, dealt to tasks in that order: each takes whole parts with
    about the rows of a file, or of ``ROWS_PER_TASK`` if files are smaller.

    Nothing is sampled. Files follow one another, so the key at which each task's files begin tells the task of a row, and
    the keys at which its files begin tell the part: the one list is as long as there are tasks, the other as a task
    has files. So rows are shuffled once. Very many rows come in a few frames, each with the next tasks: what is shuffled for
    one is gone when the next is written. ``rows`` is read for each, ``files`` several times; both should be tables.
    """
    rows_per_task = max(rows_per_file, ROWS_PER_TASK)
    total = files.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    n_tasks = max(1, -(-total // rows_per_task))
    # One row for each file: this window orders file numbers, not rows.
    earlier = Window.orderBy("bdm_id", "part").rowsBetween(Window.unboundedPreceding, -1)
    task = F.floor(F.coalesce(F.sum("rows").over(earlier), F.lit(0)) / rows_per_task).cast("int")
    begun = _keyed(files.select("bdm_id", "part", task.alias("_task"), F.col("first_date").alias("sort_date"), F.col("first_key").alias("doc_key")))
    tasks = begun.withColumn("_key", _key()).groupBy("_task").agg(*_beginnings("part"))
    begins = F.get("_keys", F.lit(0))
    first = F.broadcast(tasks.select("_task", begins.alias("_key")).agg(*_beginnings("_task")))

    passes = max(1, min(PASSES, total // ROWS_PER_PASS, n_tasks))
    cuts = [n_tasks * k // passes for k in range(passes + 1)]
    edges = [F.min(F.when(F.col("_task") >= cut, begins)) for cut in cuts[:-1]]
    most, *edges = tasks.agg(F.coalesce(F.max(F.size("_keys")), F.lit(1)), *edges).first()
    for k in range(passes):
        # The keys of a pass are filtered and not its tasks: what leads to a task would be worked out in the filter, too.
        own, at = _keyed(rows), _key()
        if k:
            own = own.filter(at >= F.lit(edges[k]))
        if k + 1 < passes and edges[k + 1] is not None:
            own = own.filter(at < F.lit(edges[k + 1]))

        def dealt(frame: DataFrame) -> DataFrame:
            place = F.col("_task") - cuts[k]  # noqa: B023
            return frame.withColumn("_place", place).drop("_task").repartitionById(cuts[k + 1] - cuts[k], F.col("_place"))  # noqa: B023

        # Both sides are dealt alike: the join shuffles nothing more.
        files_of = dealt(tasks.filter(F.col("_task").between(cuts[k], cuts[k + 1] - 1)))
        both = dealt(_placed(own.crossJoin(first), n_tasks, "_task")).join(files_of.hint("shuffle_hash"), "_place")
        yield _placed(both, most, "part").select(*rows.columns, "part").sortWithinPartitions("bdm_id", "part", *SORT_COLUMNS[1:])


def _headed(rows: DataFrame, *folders: str) -> DataFrame:
    return rows.select(*folders, *[F.col(name).alias(heading) for name, heading in SHEET_HEADINGS.items()])


def _save(rows: DataFrame, path: str, file_format: str, folders: Sequence[str], rows_per_file: int, mode: str = "overwrite") -> None:
    writer = rows.write.mode(mode).partitionBy(*folders).option("maxRecordsPerFile", rows_per_file)
    if file_format == "csv":
        writer = writer.option("header", "true")
    writer.format(file_format).save(path)


def write_detail_sheets(
    sheet: DataFrame, folder: str, file_format: str = "csv", rows_per_file: int = ROWS_PER_FILE
) -> None:
    """One folder per owner, rows ordered by date within and across its files.

    The sheet is computed once, into a table beside ``folder`` that is deleted at the end. An owner with very many rows
    is written by many tasks.
    """
    staging, kept = f"{folder.rstrip('/')}.staging", []
    with shuffles_dropped(sheet.sparkSession):
        try:
            kept.append(Stored(sheet, staging, "sheet"))
            kept.append(Stored(part_list(kept[0].frame, rows_per_file), staging, "parts"))
            for k, ordered in enumerate(_in_files(kept[0].frame, kept[1].frame, rows_per_file)):
                _save(_headed(ordered, "bdm_id"), folder, file_format, ["bdm_id"], rows_per_file, "append" if k else "overwrite")
        finally:
            for stored in kept:
                stored.delete()


class SheetStore:
    """Sheets of the latest run in a folder. A run's files are written aside and become the sheets at one moment."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder.rstrip("/")
        self._manifests = Manifests(spark, folder)

    def publish(self, sheet: DataFrame, run_id: str, file_format: str = "csv", rows_per_file: int = ROWS_PER_FILE, more: Sequence[DataFrame] = ()) -> None:
        """Make ``sheet`` and the rows of ``more`` the sheets. A run that is the latest already is not written again; what a
        failed attempt has left is never read."""
        number, state = self._manifests.latest()
        if state and state["run_id"] == run_id:
            return
        name = f"runs/{uuid.uuid4().hex}"
        with shuffles_dropped(self._spark):
            stored = Stored(sheet, f"{self._folder}/staging", "sheet", *more)
            try:
                part_list(stored.frame, rows_per_file).write.parquet(f"{self._folder}/{name}.parts")
                files = self._spark.read.schema(PART_SCHEMA).parquet(f"{self._folder}/{name}.parts")
                for k, ordered in enumerate(_in_files(stored.frame, files, rows_per_file)):
                    # A part may be larger than a file where very many rows share a day and the beginning of their keys.
                    _save(_headed(ordered, "bdm_id", "part"), f"{self._folder}/{name}", file_format, ["bdm_id", "part"], 0, "append" if k else "overwrite")
            finally:
                stored.delete()
        self._manifests.publish(number, {"run_id": run_id, "folder": name, "format": file_format})

    def manifest(self) -> DataFrame:
        """One row for each file of the latest run (``PART_SCHEMA``)."""
        state = self._manifests.latest()[1]
        if state is None:
            return self._spark.createDataFrame([], PART_SCHEMA)
        return self._spark.read.schema(PART_SCHEMA).parquet(f"{self._folder}/{state['folder']}.parts")

    def sweep(self) -> None:
        """Delete the files of earlier runs and of attempts that failed."""
        state = self._manifests.latest()[1]
        self._manifests.sweep("runs", {state["folder"], f"{state['folder']}.parts"} if state else set())
        self._manifests.sweep("staging", set())

    def folder(self) -> str | None:
        """Where the files of the latest run lie: ``bdm_id=…/part=…/``."""
        state = self._manifests.latest()[1]
        return f"{self._folder}/{state['folder']}" if state else None


def write_summary(report: DataFrame, folder: str, file_format: str = "csv") -> None:
    """Summary rows in the order of owner, customer and currency across all files. Ranges are made by sampling, so the
    report is stored first and computed once."""
    stored = Stored(report, f"{folder.rstrip('/')}.staging", "summary")
    try:
        ordered = stored.frame.repartitionByRange(*CUSTOMER_KEY).sortWithinPartitions(*CUSTOMER_KEY)
        writer = ordered.write.mode("overwrite")
        if file_format == "csv":
            writer = writer.option("header", "true")
        writer.format(file_format).save(folder)
    finally:
        stored.delete()


def append_rows(rows: DataFrame, folder: str) -> None:
    """Add rows to a log; earlier rows are never touched."""
    rows.write.mode("append").parquet(folder)


def write_outbox(outbox: DataFrame, folder: str) -> None:
    outbox.write.mode("overwrite").json(folder)


class HandOff:
    """Messages handed over to a mailer, each key once, however often a run is repeated.

    A run writes what is not handed over yet as a batch aside, then publishes the list of batches with the new one. A
    crash before that leaves a batch no list names, and the next run hands the same messages over again; a crash after it
    leaves nothing to do. Two runs at a time can't publish both: the later one starts over and finds the other's keys.
    """

    def __init__(self, spark: SparkSession, folder: str, keys: Sequence[str] = ("bdm_id", "attachment"), most_batches: int = 64):
        self._spark, self._folder, self._keys, self._most = spark, folder.rstrip("/"), list(keys), most_batches
        self._manifests = Manifests(spark, folder)

    def _read(self, batches: list[str]) -> DataFrame:
        return self._spark.read.parquet(*[f"{self._folder}/{name}" for name in batches])

    def handed_over(self) -> DataFrame | None:
        """All messages handed over, None before the first run."""
        state = self._manifests.latest()[1]
        return self._read(state["batches"]) if state and state["batches"] else None

    def write_batch(self, outbox: DataFrame, batches: list[str]) -> str:
        """First half of ``hand_over``: the messages whose keys are in no batch, once each, where nothing refers to yet."""
        fresh = outbox.filter(reduce(lambda left, key: left & F.col(key).isNotNull(), self._keys, F.lit(True))).dropDuplicates(self._keys)
        if batches:
            fresh = fresh.join(self._read(batches).select(*self._keys), self._keys, "left_anti")
        name = f"batches/{uuid.uuid4().hex}"
        fresh.select(*outbox.columns).write.parquet(f"{self._folder}/{name}")
        return name

    def hand_over(self, outbox: DataFrame, attempts: int = 5) -> DataFrame:
        """Hand over what is new in ``outbox``, and return that. Messages without a key are left out."""
        for _ in range(attempts):
            number, state = self._manifests.latest()
            batches = state["batches"] if state else []
            name = self.write_batch(outbox, batches)
            listed = [*batches, name]
            if len(listed) > self._most:  # one folder instead of many small ones
                merged = f"batches/{uuid.uuid4().hex}"
                self._read(listed).write.parquet(f"{self._folder}/{merged}")
                listed = [merged]
            try:
                self._manifests.publish(number, {"batches": listed})
            except Conflict:
                continue
            return self._read([name])
        raise Conflict(f"{attempts} attempts met other writers")

    def sweep(self) -> None:
        """Delete batches that no list names any more."""
        state = self._manifests.latest()[1]
        self._manifests.sweep("batches", set(state["batches"]) if state else set())
