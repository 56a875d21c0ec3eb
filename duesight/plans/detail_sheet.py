"""The 19-column sheet every owner gets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duesight.functions.dates import day_text, days_past_due, month_text
from duesight.functions.text import credit_text
from duesight.plans.open_items import open_items
from duesight.settings import CRN
from duesight.sources.tables import Tables

# Sheet columns and their headings, in order.
SHEET_HEADINGS = {
    "customer_name": "Customer Name",
    "invoice_number": "Invoice Number",
    "invoice_date": "Invoice Date",
    "due_date": "Due Date",
    "invoicing_currency": "Invoicing Currency",
    "amount_in_ic": "Amount in IC",
    "balance_in_ic": "Balance in IC",
    "days_of_due": "Days of Due",
    "due_status": "Due/Not Due",
    "due_month": "Due Month",
    "submitted_on": "Invoice Date Submission To Customer",
    "expected_on": "Expected Date of Collection",
    "po_ref": "Customer PO Ref.",
    "credit_period": "Credit Period",
    "contact_name": "Customer Contact Name",
    "contact_email": "Customer Email",
    "contact_phone": "Customer Contact Number",
    "project_id": "Project ID",
    "project_name": "Project Name",
}
SORT_COLUMNS = ("bdm_id", "sort_date", "doc_key")


def sheet_rows(items: DataFrame, as_of: dt.date) -> DataFrame:
    """Display form of open items. Money stays decimal until here."""
    is_credit = F.col("source") == CRN
    days = days_past_due(F.col("due_date"), as_of)
    shown_days = F.when(is_credit, 0).otherwise(F.greatest(F.coalesce(days, F.lit(0)), F.lit(0)))

    def money(name: str):
        return F.when(is_credit, credit_text(F.col(name))).otherwise(F.col(name).cast("string"))

    status = (
        F.when(is_credit | F.col("amount").isNull(), "").when(shown_days <= 0, "No Due").otherwise("Due")
    )
    return items.select(
        "bdm_id",
        "doc_key",
        F.col("invoice_date").alias("sort_date"),
        F.col("customer_label").alias("customer_name"),
        F.col("doc_no").alias("invoice_number"),
        day_text(F.col("invoice_date")).alias("invoice_date"),
        day_text(F.col("due_date")).alias("due_date"),
        F.col("currency_code").alias("invoicing_currency"),
        money("amount").alias("amount_in_ic"),
        money("balance").alias("balance_in_ic"),
        shown_days.alias("days_of_due"),
        status.alias("due_status"),
        month_text(F.col("due_date")).alias("due_month"),
        F.coalesce(day_text(F.col("submitted_on")), F.lit("-")).alias("submitted_on"),
        F.coalesce(day_text(F.col("expected_on")), F.lit("-")).alias("expected_on"),
        F.col("po_no").alias("po_ref"),
        F.col("credit_days").cast("string").alias("credit_period"),
        "contact_name",
        "contact_email",
        "contact_phone",
        F.col("project_code").alias("project_id"),
        "project_name",
    )


def detail_sheet(t: Tables, as_of: dt.date, corrected_rates: bool = False, only: str | None = None) -> DataFrame:
    """The sheet of all sources, or of ``only`` one of ``open_items.APART``."""
    return sheet_rows(open_items(t, as_of, corrected_rates, only), as_of)
