"""Invoice-level rows of the hand-written cases."""

from __future__ import annotations

import pytest

from duesight.operators.rates import asof_rate, latest_rate
from duesight.plans.detail_sheet import SHEET_HEADINGS, sheet_rows
from duesight.plans.open_items import ITEM_COLUMNS, open_items
from tests.conftest import AS_OF, records


@pytest.fixture(scope="module")
def items(cases):
    return open_items(cases, AS_OF).cache()


@pytest.fixture(scope="module")
def sheet(items):
    return {(row["bdm_id"], row["doc_key"], row["invoice_number"]): row for row in records(sheet_rows(items, AS_OF))}


@pytest.fixture(scope="module")
def by_key(items):
    return {(row["bdm_id"], row["source"], row["doc_id"]): row for row in records(items)}


def test_exactly_these_rows(by_key):
    assert set(by_key) == {
        *[(1, "INV", number) for number in (1001, 1002, 1003, 1004, 1005)],
        (4, "INV", 1020),
        (4, "INV", 1030),
        (6, "INV", 1030),
        (6, "INV", 2001),
        (6, "INV", 2002),
        (6, "INV", 2100),
        (6, "CON", 2000),
        (7, "INV", 1050),
        (2, "INV", 1070),
        (3, "INV", 1080),
        (4, "DIR", 1),
        (4, "DIR", 3),
        (4, "DIR", 6),
        (1, "CRN", 1),
        (1, "CRN", 2),
        (1, "CRN", 4),
    }


def test_columns(items, sheet):
    assert items.columns == list(ITEM_COLUMNS)
    assert len(SHEET_HEADINGS) == 19
    assert set(SHEET_HEADINGS) <= set(next(iter(sheet.values())))


def test_due_today_and_yesterday(sheet):
    today, yesterday = sheet[1, "1001", "IN1001"], sheet[1, "1002", "IN1002"]
    assert (today["days_of_due"], today["due_status"], today["due_date"]) == (0, "No Due", "15-Jun-2001")
    assert (yesterday["days_of_due"], yesterday["due_status"]) == (1, "Due")
    assert (yesterday["submitted_on"], today["submitted_on"], today["expected_on"]) == ("06-Jun-2001", "-", "-")


def test_purchase_order(sheet):
    assert sheet[1, "1001", "IN1001"]["po_ref"] == "P2"
    assert sheet[1, "1002", "IN1002"]["po_ref"] == "OWN"
    assert sheet[1, "1003", "IN1003"]["po_ref"] == "P2"
    assert sheet[4, "1020", "IN1020"]["po_ref"] is None


def test_missing_amount_has_no_status(sheet):
    row = sheet[1, "1005", "IN1005"]
    assert (row["amount_in_ic"], row["balance_in_ic"], row["due_status"]) == (None, "1600.00", "")


def test_credit_note(sheet):
    row = sheet[1, "Cr_4", "N4"]
    assert (row["amount_in_ic"], row["balance_in_ic"]) == ("(2.50)", "(2.50)")
    assert (row["days_of_due"], row["due_status"], row["due_month"]) == (0, "", "May-2001")
    assert (row["credit_period"], row["po_ref"], row["submitted_on"]) == ("0", " ", "-")


def test_consolidated_parent_shows_its_own_dates(by_key):
    row = by_key[6, "CON", 2000]
    assert (str(row["balance"]), str(row["due_date"]), row["project_code"]) == ("300.00", "2001-06-11", "P40")


def test_fan_out_is_undone_per_owner(by_key):
    assert by_key[4, "INV", 1020]["sales_order_code"] == "SO200"
    assert by_key[4, "INV", 1030]["sales_order_code"] == "SO300"
    assert by_key[6, "INV", 1030]["sales_order_code"] == "SO301"


def test_lookups(by_key):
    row = by_key[1, "INV", 1001]
    assert (row["rsh"], row["bdm"], row["business_head"], row["pm"]) == ("Dee Ray", "Ann Lee", "Fay May", None)
    assert (row["unit"], row["entity_name"], row["entity_code"]) == ("Unit", "Entity", "EN")
    assert (row["contact_name"], row["customer_label"], row["division"]) == ("Finance", "C1 - Name 1", "north")
    credit = by_key[1, "CRN", 1]
    assert (credit["unit"], credit["entity_code"], credit["sign"]) == ("U", "EN", -1)


def test_direct_invoice_names_customer_by_code_and_contact_by_id(by_key):
    first, other = by_key[4, "DIR", 1], by_key[4, "DIR", 3]
    assert (first["customer_label"], first["contact_name"], str(first["balance"])) == ("C11 - Name 11", "Second", "11.00")
    assert (other["customer_label"], other["project_code"], other["division"]) == (None, " ", " ")


def test_unknown_last_name_leaves_no_name(by_key):
    assert by_key[7, "INV", 1050]["bdm"] is None


def test_rate_that_lies_ahead(cases, by_key):
    assert {row["currency_id"]: float(row["rate"]) for row in records(latest_rate(cases.forex_conversions, AS_OF))} == {1: 1.0}
    assert {row["currency_id"]: float(row["rate"]) for row in records(asof_rate(cases.forex_conversions, AS_OF))} == {
        1: 1.0,
        2: 60.0,
    }
    assert by_key[4, "DIR", 1]["balance_base"] is None
    corrected = open_items(cases, AS_OF, corrected_rates=True).filter("source = 'DIR' and doc_id = 1")
    assert float(corrected.first()["balance_base"]) == 660.0
