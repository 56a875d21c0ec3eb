"""Invoice-level open items of all four sources, one row per owner and document."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duesight.operators.documents import (
    consolidation_routes,
    invoice_orders,
    lowest_orders,
    open_credits,
    open_direct_invoices,
    open_invoices,
    open_parents,
)
from duesight.operators.lookup import left_lookup, lowest
from duesight.operators.rates import currency_table
from duesight.operators.routes import (
    business_heads,
    detail_routes,
    fallback_purchase_orders,
    first_contacts,
    owner_orders,
    people,
)
from duesight.settings import BLANK, CON, CRN, DIR, DOC_KEY_PREFIX, INV
from duesight.sources.tables import Tables

ITEM_COLUMNS = (
    "bdm_id",
    "source",
    "doc_id",
    "doc_key",
    "customer_id",
    "customer_label",
    "division",
    "po_no",
    "contact_name",
    "contact_email",
    "contact_phone",
    "doc_no",
    "sign",
    "amount",
    "balance",
    "balance_base",
    "invoice_date",
    "credit_days",
    "due_date",
    "currency_code",
    "sales_order_code",
    "project_id",
    "project_code",
    "project_name",
    "rsh",
    "bdm",
    "business_head",
    "pm",
    "unit",
    "entity_name",
    "entity_code",
    "submitted_on",
    "expected_on",
)


# What differs between the sources' sign and id text.
_SIGN = f"if(source = '{CRN}', -1, 1)"
_DOC_KEY = f"case source when '{DIR}' then '{DOC_KEY_PREFIX[DIR]}' when '{CRN}' then '{DOC_KEY_PREFIX[CRN]}' else '' end"
_COMPUTED = {
    "doc_key": f"concat({_DOC_KEY}, doc_id)",
    "customer_label": "concat(customer_code, ' - ', customer_name)",
    "contact_name": "contact_person_name",
    "contact_email": "contact_person_email",
    "contact_phone": "contact_person_mobile",
    "sign": _SIGN,
    "balance_base": "cast(rate * balance as decimal(38,8))",
    "due_date": "date_add(invoice_date, credit_days)",
    "project_id": "shown_project_id",
}


def _finish(rows: DataFrame) -> DataFrame:
    """The canonical row. ``rows`` already carries the dimension columns."""
    return rows.selectExpr(
        *[f"{_COMPUTED[name]} as {name}" if name in _COMPUTED else name for name in ITEM_COLUMNS]
    )


def with_own_purchase_order(facts: DataFrame, t: Tables) -> DataFrame:
    """``own_po_no``: the document's own purchase order, joined while the rows are still narrow."""
    orders = t.project_purchase_orders.selectExpr("id as po_id", "attachment_reference_no as own_po_no")
    return left_lookup(facts, orders, "po_id", "doc_id").drop("po_id")


# The document's own purchase order, else its sales order's primary one.
PO_NO = "case when own_po_no <> '' then own_po_no else fallback_po_no end"


def purchase_orders(t: Tables) -> DataFrame:
    """Owner and document -> purchase order of every open project invoice."""
    own = with_own_purchase_order(invoice_orders(t), t)
    routed = own.join(fallback_purchase_orders(t), "sales_order_id", "left")
    return routed.selectExpr("bdm_id", "doc_id", f"{PO_NO} as po_no")


def _invoice_facts(invoices: DataFrame, source: str) -> DataFrame:
    return invoices.selectExpr(
        f"'{source}' as source",
        "id as doc_id",
        "project_id",
        "po_id",
        "consolidated_id",
        "invoice_code as doc_no",
        "total_amount as amount",
        "balance_amount as balance",
        "invoice_date",
        "invoice_date_submission_customer as submitted_on",
        "expected_collection_date as expected_on",
    )


def _parent_facts(t: Tables) -> DataFrame:
    """Parents with owner and the project and purchase order that describe them."""
    parents = _invoice_facts(open_parents(t), CON).drop("project_id", "po_id")
    return parents.join(consolidation_routes(t), "consolidated_id")


def _described(t: Tables, currencies: DataFrame, facts: DataFrame) -> DataFrame:
    """Invoice facts with a project, and with an owner where that is already settled."""
    on = ["project_id", "bdm_id"] if "bdm_id" in facts.columns else ["project_id"]
    routed = with_own_purchase_order(facts, t).join(detail_routes(t, currencies), on)
    return _finish(routed.withColumn("po_no", F.expr(PO_NO)))


def project_items(t: Tables, currencies: DataFrame) -> DataFrame:
    """Invoices of projects."""
    return _described(t, currencies, _invoice_facts(open_invoices(t), INV))


def consolidated_items(t: Tables, currencies: DataFrame) -> DataFrame:
    """Parents with their own amounts and dates, described by one constituent's project."""
    return _described(t, currencies, _parent_facts(t))


def invoice_items(t: Tables, currencies: DataFrame) -> DataFrame:
    """Project and consolidated invoices, rows that are equal in every column once.

    Only an invoice that stands for a consolidation can appear twice. So only those
    are compared; all others are read, joined and passed on without a shuffle for it.
    """
    invoices = open_invoices(t)
    alone = _invoice_facts(invoices.filter(F.col("consolidated_id").isNull()), INV)
    parents = _invoice_facts(invoices.filter(F.col("consolidated_id").isNotNull()), INV)
    owners = owner_orders(t).select("project_id", "bdm_id")
    both = parents.join(owners, "project_id").unionByName(_parent_facts(t))
    shown = F.struct(*[name for name in ITEM_COLUMNS if name != "source"])
    # An owner has a document as an invoice and as a parent at most.
    own = Window.partitionBy("bdm_id", "doc_id").orderBy(F.col("source") != INV)
    once = (
        _described(t, currencies, both)
        .withColumn("again", F.lag(shown).over(own).eqNullSafe(shown))
        .filter(~F.col("again"))
        .select(*ITEM_COLUMNS)
    )
    return _described(t, currencies, alone).unionByName(once)


def _direct_facts(t: Tables, currencies: DataFrame) -> DataFrame:
    """Stand-alone invoices; the customer's name is found by code."""
    facts = open_direct_invoices(t).selectExpr(
        f"'{DIR}' as source",
        "id as doc_id",
        "bdm_id",
        "customer_id",
        "customer_code",
        f"'{BLANK}' as division",
        "po_no",
        "invoice_code as doc_no",
        "total_amount as amount",
        "balance_amount as balance",
        "invoice_date",
        "credit_period as credit_days",
        "invoicing_currency_id as currency_id",
        f"'{BLANK}' as sales_order_code",
        "cast(null as long) as shown_project_id",
        f"'{BLANK}' as project_code",
        "project_name",
        "rsh_id",
        "pm_id",
        "sbu_id as unit_id",
        "entity_id",
        "invoice_date_submission_customer as submitted_on",
        "expected_collection_date as expected_on",
    )
    names = lowest(t.customers, "customer_code", "id", "customer_name").drop("id")
    units = t.company_structures.selectExpr("id as unit_id", "name as unit")
    entities = t.legal_entities.selectExpr(
        "id as entity_id", "legal_entity as entity_name", "legal_entity_code as entity_code"
    )
    # What needs a shuffle of the documents comes before what makes their rows wider.
    named = left_lookup(facts.join(names, "customer_code", "left"), first_contacts(t), "customer_id", "doc_id")
    return (
        named.join(currencies, "currency_id", "left")
        .join(units, "unit_id", "left")
        .join(entities, "entity_id", "left")
        .drop("currency_id", "entity_id")
    )


def _credit_facts(t: Tables, currencies: DataFrame) -> DataFrame:
    """Credit notes; the entity is found by name, the rate by currency code."""
    facts = open_credits(t).selectExpr(
        f"'{CRN}' as source",
        "id as doc_id",
        "bdm_id",
        "customer_no as customer_id",
        f"'{BLANK}' as po_no",
        "mode_no as doc_no",
        "balance_amount as amount",
        "balance_amount as balance",
        "date as invoice_date",
        "0 as credit_days",
        "currency as currency_code",
        "project_id",
        "rsh_id",
        "sbu as unit",
        "entity as entity_name",
        "cast(null as date) as submitted_on",
        "cast(null as date) as expected_on",
    )
    orders = t.sales_orders.selectExpr("id as sales_order_id", "sales_order_code", "sbu as unit_id")
    projects = t.projects.selectExpr(
        "id as project_id",
        "id as shown_project_id",
        "project_code",
        "project_name",
        "project_manager as pm_id",
    )
    # Tables with the same key are joined with each other, so that the notes are dealt by it once.
    of_projects = lowest_orders(t).join(orders, "sales_order_id").drop("sales_order_id").join(projects, "project_id", "full")
    customers = t.customers.withColumnRenamed("id", "customer_id").join(first_contacts(t), "customer_id", "full")
    entities = t.legal_entities.withColumnsRenamed(
        {"legal_entity": "entity_name", "legal_entity_code": "entity_code"}
    )
    entities = lowest(entities, "entity_name", "id", "entity_code").drop("id")
    by_code = currencies.filter("currency_code is not null").groupBy("currency_code")
    rates = by_code.agg(F.min_by("rate", "currency_id").alias("rate"))
    placed = left_lookup(facts, of_projects, "project_id", "doc_id")
    return (
        left_lookup(placed, customers, "customer_id", "doc_id")
        .join(rates, "currency_code", "left")
        .join(entities, "entity_name", "left")
        .drop("project_id")
    )


def _with_people(t: Tables, facts: DataFrame) -> DataFrame:
    """Staff names of documents that name them by id."""
    joined = (
        facts.join(people(t, "rsh_id", "rsh"), "rsh_id", "left")
        .join(people(t, "bdm_id", "bdm"), "bdm_id", "left")
        .join(people(t, "pm_id", "pm"), "pm_id", "left")
        .join(business_heads(t), "unit_id", "left")
    )
    return _finish(joined)


def direct_items(t: Tables, currencies: DataFrame) -> DataFrame:
    """Stand-alone invoices."""
    return _with_people(t, _direct_facts(t, currencies))


def credit_items(t: Tables, currencies: DataFrame) -> DataFrame:
    """Credit notes without a reference invoice."""
    return _with_people(t, _credit_facts(t, currencies))


# Sources whose items can be found without those of the others, the largest first.
APART = (INV, DIR, CRN)


def open_items(t: Tables, as_of: dt.date, corrected_rates: bool = False, only: str | None = None) -> DataFrame:
    """All open items. Rows of different sources are equal only as ``invoice_items`` says. ``only`` is one of ``APART``: the items of
    this source, project invoices with consolidated ones."""
    currencies = currency_table(t, as_of, corrected_rates)
    if only is not None:
        return {INV: invoice_items, DIR: direct_items, CRN: credit_items}[only](t, currencies)
    named = _direct_facts(t, currencies).unionByName(_credit_facts(t, currencies))
    return invoice_items(t, currencies).unionByName(_with_people(t, named))
