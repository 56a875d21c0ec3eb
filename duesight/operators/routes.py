"""From a project to the people and customers behind it.

Everything that fans out hangs off the project (several sales orders, approvers,
contacts). These tables are joined and made unique here, once per project and
owner, so that the documents themselves never fan out and need no dedupe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duesight.functions.text import person_name
from duesight.operators.lookup import first_per, lowest
from duesight.settings import BUSINESS_HEAD_FUNCTION
from duesight.sources.tables import Tables


# Partition column of documents that are laid out by owner, and the slot of documents several owners see.
OWNER_SLOT, SHARED = "owner_slot", -1


def of_owners(t: Tables, rows: DataFrame) -> DataFrame:
    """Rows (with ``bdm_id``) of the owners the run is for."""
    return rows if t.owners is None else rows.join(t.owners, "bdm_id", "left_semi")


def in_owner_slots(t: Tables, rows: DataFrame) -> DataFrame:
    """Documents out of the folders in which the run's owners have some.

    The slots, at most as many as the layout has and one, go to every task. They are known when the scan starts and
    prune its partitions.
    """
    if t.owners is None or OWNER_SLOT not in rows.columns:
        return rows
    own = F.array(F.pmod("bdm_id", F.lit(t.slots)).cast("int"), F.lit(SHARED))
    slots = t.owners.select(F.explode(own).alias(OWNER_SLOT)).distinct()
    return rows.join(F.broadcast(slots), OWNER_SLOT, "left_semi")


def owned_orders(t: Tables) -> DataFrame:
    """One row per project and sales order that has an owner; this is where documents fan out."""
    orders = t.sales_orders.withColumnsRenamed({"id": "sales_order_id", "sales_person_id": "bdm_id"})
    return t.project_so_masters.join(of_owners(t, orders.filter("bdm_id is not null")), "sales_order_id")


def of_owned_projects(t: Tables, rows: DataFrame) -> DataFrame:
    """Invoices of the projects that the run's owners see."""
    if t.owners is None:
        return rows
    projects = owned_orders(t).select("project_id").distinct()
    return in_owner_slots(t, rows).join(projects, "project_id", "left_semi")


def staff(t: Tables) -> DataFrame:
    """Id, number and full name of all employees."""

    def build() -> DataFrame:
        name = person_name(F.col("first_name"), F.col("last_name"))
        return t.employees.select("id", "employee_number", name.alias("full_name"))

    return t.once("staff", build)


def known_owners(t: Tables) -> DataFrame:
    return staff(t).select(F.col("id").alias("bdm_id"))


def people(t: Tables, id_name: str, label: str) -> DataFrame:
    """Employee id -> full name, under the names the caller joins on."""
    return staff(t).select(F.col("id").alias(id_name), F.col("full_name").alias(label))


def business_heads(t: Tables) -> DataFrame:
    """Unit -> name of its business head; the approver row with the lowest id wins."""

    def build() -> DataFrame:
        approvers = t.general_approvers.filter(F.col("function_id") == BUSINESS_HEAD_FUNCTION)
        first = approvers.groupBy("structure_id").agg(F.min("id").alias("id")).select("id")
        heads = approvers.join(first, "id", "left_semi").select(
            F.col("structure_id").alias("unit_id"), F.col("employee_id").alias("employee_number")
        )
        names = lowest(staff(t), "employee_number", "id", "full_name")
        named = heads.join(names, "employee_number", "left")
        return named.select("unit_id", F.col("full_name").alias("business_head"))

    return t.once("business_heads", build)


def first_contacts(t: Tables) -> DataFrame:
    """Customer -> its contact with the lowest id."""
    first = t.customer_contacts.groupBy("customer_id").agg(F.min("id").alias("id")).select("id")
    contacts = t.customer_contacts.join(first, "id", "left_semi")
    return contacts.select("customer_id", "contact_person_name", "contact_person_email", "contact_person_mobile")


def fallback_purchase_orders(t: Tables) -> DataFrame:
    """Sales order -> reference of its lowest primary purchase order."""
    primary = t.project_purchase_orders.filter(F.col("is_primary") == 1).select(
        F.col("id").alias("po_id"), "attachment_reference_no"
    )
    linked = t.po_so_masters.join(primary, "po_id")
    return linked.groupBy("sales_order_id").agg(
        F.min_by("attachment_reference_no", "po_id").alias("fallback_po_no")
    )


def summary_routes(t: Tables, currencies: DataFrame, dedupe: bool = False) -> DataFrame:
    """Project -> owner, customer, credit days, invoicing currency and rate.

    A project with several sales orders of one owner counts once for each of them;
    ``dedupe`` keeps the order with the lowest id.
    """
    orders = owned_orders(t)
    if dedupe:
        orders = first_per(orders, ["project_id", "bdm_id"], ["sales_order_id"])
    customers = t.customers.selectExpr("id as customer_id", "customer_code", "customer_name")
    projects = t.projects.selectExpr("id as project_id", "currency_id as rate_currency_id")
    rates = currencies.selectExpr("currency_id as rate_currency_id", "rate")
    return (
        orders.join(customers, "customer_id", "left")
        .join(currencies.select("currency_id", "currency_code"), "currency_id", "left")
        .join(projects, "project_id", "left")
        .join(rates, "rate_currency_id", "left")
        .selectExpr(
            "project_id",
            "bdm_id",
            "customer_code",
            "customer_name",
            "currency_code",
            "credit_period as credit_days",
            "rate",
        )
    )


def owner_orders(t: Tables) -> DataFrame:
    """The one sales order through which an owner who is an employee sees a project."""
    orders = owned_orders(t).join(known_owners(t), "bdm_id", "left_semi")
    return first_per(orders, ["project_id", "bdm_id"], ["sales_order_id"])


def detail_routes(t: Tables, currencies: DataFrame) -> DataFrame:
    """Everything an invoice row shows that depends only on its project and owner."""
    projects = t.projects.selectExpr(
        "id as project_id",
        "id as shown_project_id",
        "project_code",
        "project_name",
        "currency_id",
        "project_manager as pm_id",
    )
    customers = t.customers.selectExpr(
        "id as customer_id", "id as shown_customer_id", "customer_code", "customer_name", "division"
    )
    contacts = t.customer_contacts.drop("customer_id").withColumnRenamed("id", "finance_contact_id")
    units = t.company_structures.selectExpr("id as unit_id", "name as unit")
    entities = t.legal_entities.selectExpr(
        "id as legal_entity_id", "legal_entity as entity_name", "legal_entity_code as entity_code"
    )
    orders = owner_orders(t).drop("currency_id").withColumnRenamed("sbu", "unit_id")
    joined = (
        orders.join(fallback_purchase_orders(t), "sales_order_id", "left")  # while the rows are narrow
        .join(projects, "project_id", "left")
        .join(customers, "customer_id", "left")
        .join(contacts, "finance_contact_id", "left")
        .join(currencies, "currency_id", "left")
        .join(people(t, "rsh_id", "rsh"), "rsh_id", "left")
        .join(people(t, "bdm_id", "bdm"), "bdm_id", "left")
        .join(people(t, "pm_id", "pm"), "pm_id", "left")
        .join(business_heads(t), "unit_id", "left")
        .join(units, "unit_id", "left")
        .join(entities, "legal_entity_id", "left")
    )
    return joined.drop("customer_id").withColumnsRenamed(
        {"shown_customer_id": "customer_id", "credit_period": "credit_days"}
    )
