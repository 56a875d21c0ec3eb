"""Manifests, the compacted run log, sheets by exact counts, messages handed over once."""

from __future__ import annotations

import csv
import datetime as dt
import re
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from duesight.plans import runlog
from duesight.plans.detail_sheet import SHEET_HEADINGS, detail_sheet
from duesight.sources import sinks
from duesight.sources.manifest import Conflict, Manifests
from duesight.sources.run_log import RunLog
from duesight.sources.schemas import RUN_EVENT_SCHEMA
from tests.conftest import AS_OF

DAY = 86_400


def test_manifests(spark, tmp_path):
    first, second = Manifests(spark, str(tmp_path)), Manifests(spark, str(tmp_path))
    assert first.latest() == (0, None)
    assert first.publish(0, {"a": 1}) == 1
    with pytest.raises(Conflict):
        second.publish(0, {"a": 2})
    assert second.latest() == (1, {"a": 1})
    assert second.publish(1, {"a": 3}) == 2
    # A writer that died in the middle: its number is used up, its text does not count.
    (tmp_path / "_manifests" / "000000000003").write_text('{"a": 4}')
    assert first.latest() == (3, {"a": 3})
    assert first.publish(3, {"a": 5}) == 4 and second.latest() == (4, {"a": 5})


def events(spark, rows):
    return spark.createDataFrame(rows, RUN_EVENT_SCHEMA)


def random_events(spark, n=600):
    return spark.range(n).select(
        F.concat(F.lit("r"), F.col("id") * 7 % 90).alias("run_id"), (F.col("id") % 5).alias("schedule_id"),
        (F.col("id") * 7919 % (20 * DAY)).alias("event_ts"), F.lit(5).cast("long").alias("planned_ts"),
        (F.col("id") % 3).cast("int").alias("status"), F.concat(F.lit("m"), F.col("id") % 11).alias("message"),
    )


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


def test_compacted_log_equals_the_whole(spark, tmp_path):
    every = random_events(spark).cache()
    log = RunLog(spark, str(tmp_path))
    assert log.states().count() == 0
    log.append(every.filter("event_ts % 4 <> 1"))
    log.compact(dt.date(1970, 1, 9))
    assert rows_of(log.states()) == rows_of(runlog.run_state(every.filter("event_ts % 4 <> 1")))
    log.append(every.filter("event_ts % 4 = 1"))  # half of them for days that are in the snapshot already
    want = rows_of(runlog.run_state(every))
    assert rows_of(log.states()) == want
    log.compact(dt.date(1970, 1, 15))
    log.compact(dt.date(1970, 1, 12))  # an older day has no effect
    assert rows_of(log.states()) == want
    every.unpersist()


def test_only_later_days_are_read(spark, tmp_path):
    log = RunLog(spark, str(tmp_path))
    log.append(random_events(spark))
    log.compact(dt.date(1970, 1, 15))
    plan = log.states()._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*\(day#\d+ > 1970-01-15\)", plan)
    tail = log.events(after=dt.date(1970, 1, 15))
    days = {Path(r.f).parent.name for r in tail.select(F.input_file_name().alias("f")).distinct().collect()}
    assert days == {f"day=1970-01-{d}" for d in range(16, 21)}
    since = log.events(since=dt.date(1970, 1, 19))
    assert since.agg(F.min("event_ts") >= 18 * DAY).first()[0]


def test_crash_between_snapshot_and_switch(spark, tmp_path):
    log = RunLog(spark, str(tmp_path))
    log.append(random_events(spark))
    want = rows_of(log.states())
    log.write_snapshot(dt.date(1970, 1, 10))  # and then the driver is gone
    assert rows_of(RunLog(spark, str(tmp_path)).states()) == want
    log.append(events(spark, [("r1", 1, 30 * DAY, 5, 9, "late")]))
    log.compact(dt.date(1970, 1, 10))
    states = {r.run_id: r for r in RunLog(spark, str(tmp_path)).states().collect()}
    assert states["r1"].message == "late" and len(states) == len(want)
    log.sweep()
    assert len(list((tmp_path / "snapshots").iterdir())) == 1 and log.states().count() == len(want)


def test_latest_run_prunes_days(spark, cases, tmp_path):
    logs = spark.range(400).select(
        "id", (F.col("id") % 6).alias("schedule_id"), F.lit("x").alias("log"), F.lit(1).alias("status"),
        (F.col("id") * DAY / 10).cast("long").alias("date_runned"), (F.col("id") * DAY / 10).cast("long").alias("date_cron"),
    )
    stored = runlog.store_by_day(logs, str(tmp_path / "log"))
    plain = cases.replace(scheduler_logs=logs)
    since = dt.date(1970, 2, 1)
    found = runlog.latest_run(cases.replace(scheduler_logs=stored), since=since)
    assert rows_of(found) == rows_of(runlog.latest_run(plain, since=since))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"PartitionFilters: \[[^\]]*\(day#\d+ >= 1970-02-01\)", plan)) == plan.count("FileScan")


def sheet(spark, rows):
    """Rows of the sheet's columns out of owner, day (or None) and key."""
    table = spark.createDataFrame(rows, "bdm_id long, sort_date date, doc_key string")
    return table.withColumns({name: F.lit("x") for name in SHEET_HEADINGS if name != "invoice_number"}).withColumn("invoice_number", F.col("doc_key"))


def crowded(spark):
    day = dt.date(2001, 1, 1)
    rows = [(1, day + dt.timedelta(days=i % 40), f"{i:05d}") for i in range(300)]
    rows += [(1, dt.date(2001, 1, 10), f"h{i:05d}") for i in range(500)]  # one day with more rows than a file
    rows += [(2, None if i % 2 else day, f"n{i}") for i in range(30)] + [(3, day, "a")]
    return rows


def written(folder):
    """Rows of each owner in the order of its files."""
    out = defaultdict(list)
    for path in sorted(Path(folder).rglob("*.csv")):
        owner = next(int(p.split("=")[1]) for p in path.parts if p.startswith("bdm_id="))
        with open(path, newline="") as file:
            out[owner].append([row["Invoice Number"] for row in csv.DictReader(file)])
    return out


def test_sheet_files_follow_exact_counts(spark, tmp_path):
    rows = crowded(spark)
    sinks.write_detail_sheets(sheet(spark, rows), str(tmp_path / "sheets"), rows_per_file=50)
    got = written(tmp_path / "sheets")
    order = sorted(rows, key=lambda r: (r[0], r[1] or dt.date.min, r[2]))
    assert {owner: sum(files, []) for owner, files in got.items()} == {o: [r[2] for r in order if r[0] == o] for o in (1, 2, 3)}
    assert max(len(file) for files in got.values() for file in files) <= 50 and len(got[1]) > 10
    assert not list(tmp_path.glob("*.staging/*"))


def test_many_small_files_take_few_tasks(spark, tmp_path, monkeypatch):
    """861 rows in files of 10: each of these files had a task of its own. The files stay, with the same rows."""
    rows, dealt = crowded(spark), []
    save = sinks._save
    monkeypatch.setattr(sinks, "_save", lambda frame, *more: (dealt.append(frame.rdd.getNumPartitions()), save(frame, *more)))
    for rows_per_task in (10, 300, 250_000):
        monkeypatch.setattr(sinks, "ROWS_PER_TASK", rows_per_task)
        store = sinks.SheetStore(spark, str(tmp_path / str(rows_per_task)))
        store.publish(sheet(spark, rows), "run", rows_per_file=10)
        files = [{"/".join(p.parts[-3:-1]): p.read_text() for p in Path(store.folder()).rglob("*.csv")}]
        assert len(files[0]) == store.manifest().count() > 30
        first = files[0] if rows_per_task == 10 else first
        assert files[0] == first
    assert dealt == [84, 3, 1]


def test_rows_are_shuffled_once_and_shuffles_dropped(spark, tmp_path, monkeypatch):
    """Each file as before, whether the sheet is dealt in one pass or in four; rows go through one exchange, and what
    executions have shuffled doesn't wait for the driver's garbage collection."""
    setting, plans, save = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", [], sinks._save
    rows = crowded(spark) + [(4, dt.date(2001, 2, i % 3 + 1), None if i % 2 else f"k{i}") for i in range(60)] + [(None, dt.date(2001, 1, 1), "z"), (-5, None, "m")]

    def look(frame, *more):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        assert spark.conf.get(setting) == "true"
        save(frame, *more)

    monkeypatch.setattr(sinks, "_save", look)
    monkeypatch.setattr(sinks, "ROWS_PER_TASK", 40)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    dropped = spark.conf.get(setting)
    got, listed = [], []
    try:
        for rows_per_pass in (4_000_000, 100):
            monkeypatch.setattr(sinks, "ROWS_PER_PASS", rows_per_pass, raising=False)
            store = sinks.SheetStore(spark, str(tmp_path / str(rows_per_pass)))
            store.publish(sheet(spark, rows), "run", rows_per_file=10)
            got.append(sorted((*p.parts[-3:-1], p.read_text()) for p in Path(store.folder()).rglob("*.csv")))
            listed.append(sorted(map(str, store.manifest().collect())))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert spark.conf.get(setting) == dropped
    assert got[0] == got[1] and listed[0] == listed[1] and len(got[0]) == len(listed[0])
    keys = [(int(owner.split("=")[1]), line["Invoice Number"]) for owner, _, text in got[0] for line in csv.DictReader(text.splitlines())]
    assert Counter(keys) == Counter((r[0], r[2] or "") for r in rows if r[0] is not None)
    for plan in plans:  # the sheet's rows: what an exchange reads has all columns
        below = [part.split("Scan")[0] for part in re.split(r"(?<!Broadcast)Exchange ", plan)[1:]]
        assert sum("project_name#" in part for part in below) == 1
    assert len(plans) == 5


def test_more_passes_than_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "ROWS_PER_PASS", 100)
    store = sinks.SheetStore(spark, str(tmp_path))
    store.publish(sheet(spark, crowded(spark)), "run")
    assert {owner: len(sum(files, [])) for owner, files in written(store.folder()).items()} == {1: 800, 2: 30, 3: 1}


def test_the_sheet_is_computed_once(spark, cases, tmp_path):
    ran = spark.sparkContext.accumulator(0)

    def look(batches):
        for batch in batches:
            ran.add(len(batch))
            yield batch

    rows = sheet(spark, crowded(spark))
    seen = rows.mapInPandas(look, rows.schema)
    sinks.write_detail_sheets(seen, str(tmp_path / "sheets"), rows_per_file=100)
    assert ran.value == rows.count()


def test_published_sheets_switch_at_once(spark, cases, tmp_path):
    store = sinks.SheetStore(spark, str(tmp_path))
    assert store.folder() is None and store.manifest().count() == 0
    store.publish(sheet(spark, crowded(spark)), "run-1", rows_per_file=100)
    first = store.folder()
    files = store.manifest().collect()
    got = written(first)
    assert sorted((r.bdm_id, r.rows) for r in files) == sorted((o, len(f)) for o, fs in got.items() for f in fs)
    for r in files:
        (path,) = Path(first, f"bdm_id={r.bdm_id}", f"part={r.part}").glob("*.csv")
        with open(path, newline="") as file:
            keys = [row["Invoice Number"] for row in csv.DictReader(file)]
        assert (len(keys), keys[0], keys[-1]) == (r.rows, r.first_key, r.last_key)
    store.publish(sheet(spark, crowded(spark)), "run-1")  # a retry
    assert store.folder() == first and len(list((tmp_path / "runs").iterdir())) == 2

    def broken(batches):
        raise ValueError("lost")

    new = detail_sheet(cases, AS_OF)
    with pytest.raises(Exception, match="lost"):
        store.publish(new.mapInPandas(broken, new.schema), "run-2")
    assert store.folder() == first
    store.publish(new, "run-2")
    assert store.folder() != first and {r.bdm_id for r in store.manifest().collect()} == {1, 2, 3, 4, 6, 7}
    store.sweep()
    assert {p.name for p in (tmp_path / "runs").iterdir()} == {Path(store.folder()).name, f"{Path(store.folder()).name}.parts"}
    assert store.manifest().count() == len(list(Path(store.folder()).rglob("*.csv")))


def outbox(spark, owners, text="x"):
    return spark.createDataFrame([(o, f"{o}@example.com", f"report_{o}.csv", text) for o in owners], "bdm_id long, to_email string, attachment string, subject string")


def keys_of(df):
    return sorted(r.bdm_id for r in df.collect())


def test_messages_are_handed_over_once(spark, tmp_path):
    box = sinks.HandOff(spark, str(tmp_path), most_batches=3)
    assert box.handed_over() is None
    assert keys_of(box.hand_over(outbox(spark, [1, 2]))) == [1, 2]
    assert keys_of(box.hand_over(outbox(spark, [1, 2]))) == []
    assert keys_of(box.hand_over(outbox(spark, [2, 3, 3], "later"))) == [3]
    box.write_batch(outbox(spark, [4]), [])  # a run that died before it published
    assert keys_of(box.handed_over()) == [1, 2, 3]
    assert keys_of(box.hand_over(outbox(spark, [4, None]))) == [4]
    assert keys_of(box.handed_over()) == [1, 2, 3, 4]
    assert len(box._manifests.latest()[1]["batches"]) == 1  # more than three were put into one
    assert {r.subject for r in box.handed_over().collect()} == {"x", "later"}
    box.sweep()
    assert keys_of(box.handed_over()) == [1, 2, 3, 4] and len(list((tmp_path / "batches").iterdir())) == 1


def test_two_runs_at_a_time(spark, tmp_path, monkeypatch):
    one, two = sinks.HandOff(spark, str(tmp_path)), sinks.HandOff(spark, str(tmp_path))
    usual, first = one.write_batch, []

    def overtaken(rows, batches):
        if not first:
            first.append(two.hand_over(outbox(spark, [1, 5])))
        return usual(rows, batches)

    monkeypatch.setattr(one, "write_batch", overtaken)
    assert keys_of(one.hand_over(outbox(spark, [1, 2]))) == [2]
    assert keys_of(one.handed_over()) == [1, 2, 5]
