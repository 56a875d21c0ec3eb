"""What plans read: one pass for the summary, an owner's part of the documents, no sampling, no pairs."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from duesight.checks.queries import REGISTRY
from duesight.operators.facts import beside_facts
from duesight.operators.ranking import with_rank
from duesight.operators.rates import asof_rate, asof_rate_by_day
from duesight.plans import open_items, people
from duesight.plans.summary import AgeingSummary
from duesight.settings import DEFAULT_AS_OF
from duesight.sources.owner_layout import store_by_owner
from duesight.sources.starmap import star_tables
from tests.conftest import AS_OF

FOLDER = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["summary_report", "visible_buckets", "visible_spans", "summary_merged", "grand_total", "notification_outbox"])
def test_summary_reads_its_sources_once(spark, name):
    """Exposure itself reads invoices three times, and orders for consolidations, constituents, credits and lines."""
    plan = plan_of(REGISTRY[name].run(spark, FOLDER))
    assert len(re.findall(r"FileScan[^\n]*/orders.parquet", plan)) <= 8


def test_facts_reach_every_row_of_their_owner(spark):
    rows = spark.range(1000).select((F.col("id") % 3).alias("owner"), (F.col("id") % 100).alias("k"), (F.col("id") % 7).alias("v"))
    told = beside_facts(rows, ["owner", "k"], [F.sum("v").alias("v")], ["owner"], ["owner"], {"all": lambda fact: F.max(F.when(fact, F.col("v")))}, spread=5)
    whole = {r.owner: r.n for r in rows.groupBy("owner").agg(F.sum("v").alias("n")).collect()}
    got = told.collect()
    assert len(got) == 300 and all(r["all"] == whole[r.owner] for r in got)
    assert len({r._part for r in got if r.owner == 1}) == 5


def owners_of(cases, *ids):
    return cases.debtor_reports.filter(F.col("bdm_id").isin(*ids))


@pytest.mark.parametrize("ids", [(1,), (2, 4), (99,)])
def test_a_run_for_some_owners(spark, cases, tmp_path, ids):
    """Equals the filtered run for all, with and without the layout by owner."""
    want = rows_of(open_items.open_items(cases, AS_OF).filter(F.col("bdm_id").isin(*ids)))
    summary = rows_of(AgeingSummary(cases, AS_OF).report().filter(F.col("bdm_id").isin(*ids)))
    stored = store_by_owner(cases, str(tmp_path), slots=3)
    for t in (cases, stored):
        own = t.of_owners(owners_of(cases, *ids))
        assert rows_of(open_items.open_items(own, AS_OF)) == want
        assert rows_of(AgeingSummary(own, AS_OF).report()) == summary
    assert rows_of(open_items.open_items(stored, AS_OF)) == rows_of(open_items.open_items(cases, AS_OF))


def test_an_owner_reads_its_folders(spark, tmp_path):
    t = star_tables(spark, FOLDER)
    stored = store_by_owner(t, str(tmp_path), slots=10)
    assert {r[0] for r in stored.invoices.select("owner_slot").distinct().collect()} == {-1, *range(10)}
    own = stored.of_owners(t.debtor_reports.filter("bdm_id = 3"))
    items = open_items.open_items(own, DEFAULT_AS_OF)
    assert rows_of(items) == rows_of(open_items.open_items(t, DEFAULT_AS_OF).filter("bdm_id = 3"))
    plan = plan_of(items)
    assert re.search(r"FileScan parquet \[[^\]]*consolidated_id#[^\n]*PartitionFilters: [^\n]*dynamicpruning", plan)
    assert re.search(r"FileScan parquet \[[^\]]*customer_code#[^\n]*PartitionFilters: [^\n]*dynamicpruning", plan)


def test_rates_of_many_days_equal_those_of_each(spark, cases):
    history = spark.range(300).select(
        "id", (F.col("id") % 4).alias("from_currency_id"), F.date_add(F.lit(dt.date(2001, 1, 1)), (F.col("id") * 37 % 400).cast("int")).alias("date"),
        F.col("id").cast("decimal(18,6)").alias("value"),
    )
    days = [dt.date(2000, 12, 1) + dt.timedelta(days=k * 13) for k in range(50)] + [None]
    report = spark.createDataFrame([(d,) for d in [*days, days[3]]], "report_date date")
    got = asof_rate_by_day(history, report, bucket_days=16)
    want = sorted((str(d), r.currency_id, r.rate, r.rate_date) for d in days if d for r in asof_rate(history, d).collect())
    assert sorted((str(r.report_date), r.currency_id, r.rate, r.rate_date) for r in got.collect()) == want
    plan = plan_of(got)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert asof_rate_by_day(history, report.filter("false")).count() == 0


def test_rank_of_a_crowded_group(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 3 == 0, F.col("id") % 5).alias("g"), (F.col("id") * 7919 % 4001).alias("k"), F.lit("x").alias("_x"))
    ranked = with_rank(rows, ["g"], ["k"], ranges=9, sample=20)
    assert "_range" in plan_of(ranked)
    groups = {}
    for r in ranked.collect():
        groups.setdefault(r.g, []).append((r.rank, r.k))
    for found in groups.values():
        found.sort()
        assert [rank for rank, _ in found] == list(range(len(found)))
        assert [k for _, k in found] == sorted(k for _, k in found)
    assert with_rank(rows.filter("false"), ["g"], ["k"]).count() == 0


def test_lists_come_in_parts(spark):
    rows = spark.range(250).select(F.lit(7).alias("function_id"), F.lit("Ann").alias("greeting"), F.when(F.col("id") % 5 == 0, "cc").otherwise("to").alias("mail_to_type"), F.when(F.col("id") != 3, F.format_string("a%03d@example.com", "id")).alias("email"))
    parts = sorted(people.recipient_lists(rows, most=60).collect(), key=lambda r: r.part)
    assert [len(r.to_list) for r in parts] == [60, 60, 60, 19] and [len(r.cc_list) for r in parts] == [50, 0, 0, 0]
    every = sum((r.to_list for r in parts), [])
    assert every == sorted(every) and len(set(every)) == 199
