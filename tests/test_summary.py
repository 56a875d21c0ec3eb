"""Summaries of the hand-written cases."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duesight.plans.summary import AgeingSummary
from duesight.settings import SummaryOptions
from duesight.sources.tables import Tables, collated
from tests.conftest import AS_OF, records

ADDED = SummaryOptions(future_credits_added=True)
DEDUPED = SummaryOptions(dedupe_orders=True)
LONG = SummaryOptions(consolidated_horizon=True)


@pytest.fixture(scope="module")
def summary(cases):
    return AgeingSummary(cases, AS_OF)


def cells(df, owner, code, value="net_amount"):
    return {
        row["bucket"]: float(row[value])
        for row in records(df.filter(f"bdm_id = {owner} and customer_code = '{code}'"))
    }


@pytest.fixture(scope="module")
def merged(summary):
    return summary.merged().cache()


def test_buckets_of_one_customer(merged):
    assert cells(merged, 1, "C1") == {
        "past": 1600.0,
        "m-3": 800.0,
        "m-1": 400.0 - 2.5,
        "current_due": 200.0,
        # deleted invoices count in the summary, unapproved ones do not
        "current_not_due": 100.0 + 9.0,
        # a revised invoice and its revision both count; the credit reduces them
        "p1": 10.0 + 20.0 - 5.0,
        # past the horizon of this owner
        "unplaced": -6.0,
    }


def test_credits_of_future_months_can_be_added(cases):
    assert cells(AgeingSummary(cases, AS_OF, ADDED).merged(), 1, "C1")["p1"] == 35.0


def test_grand_total_ignores_the_unplaced_and_subtracts_credits(summary):
    totals = {
        (row["bdm_id"], row["customer_code"]): float(row["grand_total"])
        for row in records(summary.grand_total())
    }
    assert totals[1, "C1"] == 1600 + 800 + 397.5 + 200 + 109 + 25
    assert totals[7, "C5"] == 123456.5


def test_total_is_the_sum_of_placed_buckets(summary, merged):
    placed = merged.filter("bucket <> 'unplaced'").groupBy("bdm_id", "customer_code").sum("net_amount")
    sums = {(row[0], row[1]): row[2] for row in placed.collect()}
    for row in records(summary.grand_total()):
        assert sums[row["bdm_id"], row["customer_code"]] == row["grand_total"]


def test_two_orders_of_one_owner_count_twice_unless_deduped(cases, merged):
    assert cells(merged, 4, "C2") == {"current_not_due": 50.0, "p1": 50.0}
    deduped = AgeingSummary(cases, AS_OF, DEDUPED)
    assert cells(deduped.merged(), 4, "C2") == {"current_not_due": 50.0}


def test_two_owners_each_see_the_invoice(merged):
    assert cells(merged, 4, "C3") == cells(merged, 6, "C3") == {"current_not_due": 70.0}


def test_consolidation_counts_its_constituents_by_their_own_dates(summary, merged):
    by_source = summary.by_source().filter("source = 'CON'")
    assert cells(by_source, 6, "C4", "amount") == {"m-1": 100.0, "current_not_due": 200.0}
    # the constituents are ordinary invoices as well
    assert cells(merged, 6, "C4") == {"m-1": 200.0, "current_not_due": 400.0}


def test_direct_invoice_whose_code_is_no_candidate_is_left_out(summary, merged):
    assert cells(merged, 4, "C12") == {}
    # duplicates, deleted and revised ones all count
    assert cells(merged, 4, "C11") == {"current_due": 11.0 + 12 + 14 + 15 + 16}
    codes = {row["customer_code"] for row in records(summary.candidate_customers()) if row["bdm_id"] == 4}
    assert codes == {"C2", "C3", "C11", "CX"}


def test_overpaid_invoice_makes_a_candidate_but_no_row(summary, merged):
    candidates = {(row["bdm_id"], row["customer_code"]) for row in records(summary.candidate_customers())}
    assert (1, "C10") in candidates
    assert cells(merged, 1, "C10") == {}


def test_unknown_owner_has_a_summary(merged):
    assert cells(merged, 99, "C9") == {"current_not_due": 1.0}


def test_horizon(cases, summary):
    horizon = {row["bdm_id"]: (str(row["last_due_date"]), row["months"]) for row in records(summary.horizon())}
    assert horizon[1] == ("2001-07-11", 1)
    assert horizon[4] == ("2001-07-15", 1)
    assert horizon[7] == ("2001-05-31", 0)
    longer = AgeingSummary(cases, AS_OF, LONG).horizon().filter("bdm_id = 6").first()
    assert str(longer["last_due_date"]) == "2001-06-20"


def test_hidden_bucket_is_still_in_the_total(summary):
    visible = {(row["bdm_id"], row["bucket"]) for row in records(summary.visible_buckets())}
    # no rate, so nothing adds up to a visible column
    assert not [bucket for owner, bucket in visible if owner == 7]
    assert (1, "current_due") in visible and (1, "p1") in visible
    row = summary.report().filter("bdm_id = 7").first()
    assert (row["m1"], row["past"], row["grand_total"]) == (None, None, "123,457")


def test_column_totals_add_credits_and_do_not_need_approval(summary):
    totals = summary.bucket_totals().filter("bdm_id = 1")
    values = {(row["source"], row["bucket"]): float(row["total"]) for row in records(totals)}
    assert values["CRN", "p1"] == 5.0
    assert values["INV", "current_not_due"] == 100 + 9 + 7


def test_report_row(summary):
    row = summary.report().filter("bdm_id = 1").first()
    assert row["customer_label"] == "C1 - Name 1"
    assert (row["past"], row["m3"], row["m2"], row["m1"]) == ("1,600", "800", None, "398")
    assert (row["current_due"], row["current_not_due"], row["future_months"]) == ("200", "109", "Jul-01=25")
    assert row["grand_total"] == "3,132"


def test_wide_summary_has_a_column_per_month(summary):
    wide = summary.wide()
    assert wide.columns[3:] == ["past", "m-3", "m-2", "m-1", "current_due", "current_not_due", "p1"]
    row = wide.filter("bdm_id = 1 and customer_code = 'C1'").first()
    assert (float(row["p1"]), row["m-2"]) == (25.0, None)


def test_visible_spans(summary):
    spans = {row["bdm_id"]: row for row in records(summary.visible_spans())}
    assert (spans[1]["due_columns"], spans[1]["not_due_columns"]) == (4, 2)
    assert 7 not in spans


def test_collated_codes_are_compared_once(cases):
    """Typed codes find the same candidates, and what follows the one comparison groups plain text."""
    typed = cases.replace(direct_invoices=cases.direct_invoices.withColumn("customer_code", F.concat(F.lower("customer_code"), F.lit(" "))))
    alike = AgeingSummary(Tables(lambda name: collated(getattr(typed, name), name)), AS_OF)
    assert alike.base.schema["customer_code"].dataType != T.StringType()
    assert alike._cells().schema["customer_code"].dataType == T.StringType()
    assert sorted(map(str, records(alike.merged()))) == sorted(map(str, records(AgeingSummary(cases, AS_OF).merged())))
    assert sorted(map(str, records(alike.bucket_totals()))) == sorted(map(str, records(AgeingSummary(cases, AS_OF).bucket_totals())))
