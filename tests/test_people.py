"""Owners, copies, configuration, outbox and run log of the hand-written cases."""

from __future__ import annotations

import datetime as dt

from duesight.plans import notify, people, runlog
from duesight.plans.summary import AgeingSummary
from tests.conftest import AS_OF, hand_tables, records

FRIDAY = dt.datetime(2001, 6, 15, 9, 30, 20)


def test_report_owners_keep_the_unknown(cases):
    owners = {row["bdm_id"]: row for row in records(people.report_owners(cases))}
    assert len(owners) == 8
    assert (owners[99]["owner_name"], owners[99]["email"]) == ("", None)
    assert owners[7]["owner_name"] == "Gil"


def test_active_owners(cases):
    assert {row["bdm_id"] for row in records(people.active_owners(cases))} == {1, 4, 5, 6, 7}


def test_copies_ignore_case_and_inactive_entries(cases):
    assert {(row["bdm_id"], row["cc_name"], row["cc_email"]) for row in records(people.owner_cc(cases))} == {
        (1, "Ann Lee", "ann@example.com"),
        (1, "Dee Ray", "dee@example.com"),
    }


def test_recipients(cases):
    rows = {(row["mail_to_type"], row["email"]): row for row in records(people.recipients_by_type(cases))}
    assert rows["to", "ann@example.com"]["entries"] == 2
    assert rows["to", "ann@example.com"]["greeting"] == "Dee"
    assert set(rows) == {("to", "ann@example.com"), ("to", "dee@example.com"), ("cc", "fay@example.com")}
    one = records(people.recipients_by_type(cases, "to", function_id=9, structure_id=1))
    assert [(row["email"], row["greeting"]) for row in one] == [("ann@example.com", "Ann")]
    lists = people.recipient_lists(people.recipients_by_type(cases)).filter("part = 0").first()
    assert (lists["to_list"], lists["bcc_list"]) == (["ann@example.com", "dee@example.com"], [])


def test_configuration(cases):
    merged = {row["configuration_key"]: row["configuration_value"] for row in records(people.config_map_merged(cases))}
    assert merged == {
        "host": "server",
        "ar_from": "new",
        "debtors_bdm_cron_bcc": "x@example.com, y@example.com,,",
    }
    lookup = people.config_lookup(cases).first()
    assert tuple(lookup) == ("job", 59, 1)


def test_outbox(cases):
    rows = {row["bdm_id"]: row for row in records(notify.notification_outbox(cases, AgeingSummary(cases, AS_OF)))}
    # not: who left, whose status is unknown, who has nothing to report, who is no employee
    assert set(rows) == {1, 4, 6, 7}
    assert [tuple(copy) for copy in rows[1]["cc"]] == [("Dee Ray", "dee@example.com")]
    assert rows[4]["cc"] == []
    assert rows[1]["bcc"] == ["x@example.com", "y@example.com"]
    assert (rows[1]["from_email"], rows[1]["from_name"]) == ("new", "Accounts Receivable")
    assert rows[1]["subject"] == "debtors_report_Ann_Lee_15-Jun-2001"
    assert rows[1]["attachment"] == "debtors_report_Ann_Lee_15-Jun-2001.csv"


def test_outbox_without_blind_copies(spark, cases):
    bare = cases.replace(configuration_values=hand_tables(spark).configuration_values)
    assert tuple(notify.mail_settings(bare).first()) == ([], None)
    rows = notify.notification_outbox(bare, AgeingSummary(cases, AS_OF)).collect()
    assert rows and all(row["bcc"] == [] and row["from_email"] is None for row in rows)


def test_failure_causes(spark):
    rows = [("refused", "x"), ("mailer", " <b>y</b>\n"), ("other", "z"), (None, "<i"), ("new", None)]
    failures = spark.createDataFrame(rows, "cause string, message string")
    got = notify.error_events(failures, dt.datetime(2001, 6, 15)).collect()
    assert [(r.error_description, r.data) for r in got] == [
        ("Mail not sent", ""),
        ("Mail not sent, PHP Mailer Exception", "y"),
        ("Mail not sent, Exception", "z"),
        ("Mail not sent, Exception", ""),
        ("Mail not sent, Exception", None),
    ]


def test_due_schedules(cases):
    assert [tuple(row) for row in runlog.due_schedules(cases, FRIDAY).collect()] == [
        ("job", 2, 9, 30, int(dt.datetime(2001, 6, 15, 9, 30, 20, tzinfo=dt.UTC).timestamp()))
    ]


def test_run_log(spark, cases):
    starts = runlog.start_events(runlog.due_schedules(cases, FRIDAY), FRIDAY)
    running = runlog.run_state(starts).first()
    assert (running["status"], running["schedule_id"]) == (None, 2)
    ends = runlog.end_events(starts, FRIDAY + dt.timedelta(minutes=1), runlog.FAILED, "Failure <b>x</b>")
    state = runlog.run_state(starts.unionByName(ends)).first()
    assert (state["status"], state["message"], state["event_ts"] - state["started_ts"]) == (0, "Failure x", 60)


def test_latest_run(spark):
    logs = [
        {"id": number, "schedule_id": schedule, "status": status, "date_runned": run, "date_cron": run}
        for number, schedule, status, run in [(1, 1, 1, 100), (2, 1, 0, 200), (3, 1, 1, 200), (4, 2, 1, 90_000)]
    ]
    tables = hand_tables(spark, scheduler_logs=logs)
    assert {row["schedule_id"]: row["id"] for row in records(runlog.latest_run(tables))} == {1: 3, 2: 4}
    assert [row["id"] for row in records(runlog.latest_run(tables, schedule_id=2))] == [4]
    assert [row["id"] for row in records(runlog.latest_run(tables, since=dt.date(1970, 1, 2)))] == [4]
    assert [row["id"] for row in records(runlog.latest_run(tables, parts={"d": 1, "H": 0}))] == [3]


def test_error_events(spark):
    failures = spark.createDataFrame([("\t<b>down</b> \n",)], "message string")
    row = notify.error_events(failures, FRIDAY).first()
    assert (row["data"], row["error_description"]) == ("down", "Mail not sent, Exception")
