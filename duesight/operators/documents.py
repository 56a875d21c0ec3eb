"""Which documents are open, and which of several rows for one document counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duesight.operators.lookup import first_per
from duesight.operators.routes import in_owner_slots, known_owners, of_owned_projects, of_owners, owner_orders
from duesight.settings import APPROVED_STATUS
from duesight.sources.tables import Tables


def without_revised(documents: DataFrame, all_documents: DataFrame) -> DataFrame:
    """Drop documents that a later one refers to.

    The references are made distinct first: a document that very many others
    refer to is then one row, not one hot partition.
    """
    revised = (
        all_documents.filter(F.col("invoice_reference").isNotNull())
        .select(F.col("invoice_reference").alias("id"))
        .distinct()
    )
    return documents.join(revised, "id", "left_anti")


def _revises_none() -> Column:
    """No reference to an earlier document; 0 is an empty reference."""
    return F.coalesce("invoice_reference", F.lit(0)) == 0


def _approved_open(t: Tables) -> DataFrame:
    """Approved, unpaid invoices that revise no other."""
    return t.invoices.filter(
        (F.col("status") == APPROVED_STATUS)
        & (F.col("deleted") == 0)
        & (F.col("balance_amount") > 0)
        & _revises_none()
    )


def open_invoices(t: Tables) -> DataFrame:
    """Approved, unpaid invoices that neither revise another nor were revised."""
    return without_revised(of_owned_projects(t, _approved_open(t)), t.invoices)


def invoice_orders(t: Tables) -> DataFrame:
    """Owner and open invoice -> the one sales order through which the owner sees it."""
    invoices = open_invoices(t).select(F.col("id").alias("doc_id"), "project_id", "po_id")
    chosen = owner_orders(t).select("project_id", "bdm_id", "sales_order_id")
    return invoices.join(chosen, "project_id").select("bdm_id", "doc_id", "sales_order_id", "po_id")


def open_parents(t: Tables) -> DataFrame:
    """Approved, unpaid invoices that stand for a consolidation."""
    consolidations = t.invoice_consolidations.withColumnRenamed("id", "consolidated_id")
    parents = _approved_open(t).filter(F.col("consolidated_id").isNotNull())
    return parents.join(consolidations, "consolidated_id", "left_semi")


def consolidation_routes(t: Tables) -> DataFrame:
    """Consolidation and owner -> the constituent invoice whose project describes the parent.

    Chosen per consolidation before any parent is joined, so parents and
    constituents are never paired with each other. Lowest sales order, then
    project, then invoice wins.
    """
    constituents = of_owned_projects(t, t.invoices.filter(F.col("invoice_reference").isNull())).select(
        F.col("id").alias("invoice_id"), "project_id", "po_id"
    )
    orders = owner_orders(t).select("project_id", "bdm_id", "sales_order_id")
    candidates = (
        t.invoice_consolidation_details.withColumnRenamed("invoice_consolidation_id", "consolidated_id")
        .join(constituents, "invoice_id")
        .join(orders, "project_id")
    )
    return first_per(
        candidates, ["consolidated_id", "bdm_id"], ["sales_order_id", "project_id", "invoice_id"]
    ).select("consolidated_id", "bdm_id", "project_id", "po_id")


def open_direct_invoices(t: Tables) -> DataFrame:
    """Unpaid stand-alone invoices of known owners, one per owner and invoice code."""
    unpaid = t.direct_invoices.filter((F.col("balance_amount") > 0) & (F.col("deleted") == 0))
    owned = of_owners(t, in_owner_slots(t, unpaid))
    current = without_revised(owned, t.direct_invoices).join(known_owners(t), "bdm_id", "left_semi")
    return first_per(current, ["bdm_id", "invoice_code"], ["id"])


def unpaid_credits(t: Tables) -> DataFrame:
    """Credit notes that are not used up, with owner and customer."""
    notes = t.credit_notes.filter((F.col("balance_amount") > 0) & (F.col("deleted") == 0))
    references = of_owners(t, t.credit_references.filter(F.col("bdm_id").isNotNull()))
    return notes.join(
        references.withColumnRenamed("credit_note_id", "id"), "id"
    )


def lowest_orders(t: Tables) -> DataFrame:
    """Project -> its lowest sales order."""
    known_orders = t.sales_orders.select(F.col("id").alias("sales_order_id"))
    return (
        t.project_so_masters.join(known_orders, "sales_order_id", "left_semi")
        .groupBy("project_id")
        .agg(F.min("sales_order_id").alias("sales_order_id"))
    )


def open_credits(t: Tables) -> DataFrame:
    """One row per owner and credit-note number, with the project's lowest sales order."""
    routed = unpaid_credits(t).join(lowest_orders(t), "project_id", "left")
    order = [
        F.col("id"),
        F.col("sales_order_id").asc_nulls_last(),
        F.col("project_id").asc_nulls_last(),
        F.col("customer_no").asc_nulls_last(),
    ]
    return first_per(routed, ["bdm_id", "mode_no"], order)
