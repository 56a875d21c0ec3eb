"""Receivables tables derived from the star-schema test tables.

Every expression is deterministic and row-wise or one aggregation per order, so
the derived tables grow with the given ones. Hot customers cost no pairs: no
table is joined with itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duesight.settings import CC_FUNCTION_PREFIX
from duesight.sources.schemas import RUN_EVENT_SCHEMA, SCHEMAS, columns_of
from duesight.sources.tables import Tables

# Columns of the given tables that are used, so that reading needs no schema inference.
GIVEN = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int",
    "part": "p_partkey long, p_name string, p_type string, p_size int",
    "orders": (
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double,"
        " o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey long, l_extendedprice double, l_discount double, l_returnflag string,"
        " l_shipdate timestamp_ntz"
    ),
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string",
    "rates": "event_id long, ts timestamp_ntz, user_id long, value double",
    "pages": "page_id long, html string",
}
FILES = {"rates": "events"}

OWNERS = 10
CREDIT_DAYS = (
    "case c_mktsegment when 'MACHINERY' then 30 when 'BUILDING' then 45"
    " when 'AUTOMOBILE' then 60 when 'FURNITURE' then 90 end"
)
CURRENCY_OF_REGION = "if(r_regionkey = 0, 'INR', r_name)"


class _Star:
    """The given parquet tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        path = f"{self._folder}/{FILES.get(name, name)}.parquet"
        frame = self._spark.read.schema(GIVEN[name]).parquet(path)
        setattr(self, name, frame)
        return frame

    @property
    def customer_place(self) -> DataFrame:
        return self.customer.join(self.nation.withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey")

    @property
    def order_place(self) -> DataFrame:
        orders = self.orders.selectExpr("o_orderkey", "o_custkey as c_custkey")
        return orders.join(self.customer_place, "c_custkey")


def _typed(rows: DataFrame, schema: str, expressions: dict[str, str]) -> DataFrame:
    kinds = columns_of(schema)
    return rows.selectExpr(*[f"cast({expressions[name]} as {kind}) as {name}" for name, kind in kinds.items()])


def _employees(star: _Star):
    return star.supplier, {
        "id": "s_suppkey",
        "employee_number": "concat('E', s_suppkey)",
        "first_name": "substring_index(s_name, '#', 1)",
        "last_name": "if(s_suppkey % 11 <> 7, substring_index(s_name, '#', -1), null)",
        "work_email_address": "if(s_suppkey % 13 <> 5, concat('e', s_suppkey, '@example.com'), null)",
        "structure_name": "concat('NATION_', s_nationkey)",
        "employment_status": "case when s_suppkey % 7 = 3 then 'r' when s_suppkey % 9 <> 8 then 'c' end",
    }


def _customers(star: _Star):
    return star.customer, {
        "id": "c_custkey",
        "customer_code": "concat('C', c_custkey)",
        "customer_name": "c_name",
        "division": "c_mktsegment",
    }


# One order per customer; a second under the next owner for every fourth customer, and a third
# under the same owner, in another currency, for every sixth.
ORDER_COPIES = (
    "explode(filter(array(0, if(c_custkey % 4 = 0, 1, null), if(c_custkey % 6 = 0, 2, null)),"
    " copy -> copy is not null)) as copy"
)


def _sales_orders(star: _Star):
    return star.customer_place.selectExpr("*", ORDER_COPIES), {
        "id": "c_custkey * 4 + copy",
        "sales_order_code": "concat('SO', c_custkey * 4 + copy)",
        "credit_period": f"if(copy = 2, 15, {CREDIT_DAYS})",
        "customer_id": "c_custkey",
        "finance_contact_id": "c_custkey * 2 + if(c_custkey % 3 = 0, 1, 0)",
        "rsh_id": f"(c_custkey + 3) % {OWNERS}",
        "sales_person_id": f"(c_custkey + if(copy = 1, 1, 0)) % {OWNERS}",
        "sbu": "c_nationkey",
        "currency_id": "(n_regionkey + if(copy = 2, 1, 0)) % 5",
        "legal_entity_id": "n_regionkey",
    }


def _project_so_masters(star: _Star):
    return star.customer.selectExpr("c_custkey", ORDER_COPIES), {
        "project_id": "c_custkey",
        "sales_order_id": "c_custkey * 4 + copy",
    }


def _projects(star: _Star):
    return star.customer_place, {
        "id": "c_custkey",
        "project_code": "concat('P', c_custkey)",
        "project_name": "concat(c_name, ' works')",
        "currency_id": "n_regionkey",
        "project_manager": f"(c_custkey + 5) % {OWNERS}",
    }


def _customer_contacts(star: _Star):
    copies = "explode(if(c_custkey % 3 = 0, array(0, 1), array(0))) as copy"
    return star.customer.selectExpr("c_custkey", copies), {
        "id": "c_custkey * 2 + copy",
        "customer_id": "c_custkey",
        "contact_person_name": "concat('Contact ', c_custkey * 2 + copy)",
        "contact_person_email": "concat('c', c_custkey * 2 + copy, '@example.org')",
        "contact_person_mobile": "concat('+91 ', c_custkey * 2 + copy + 1000)",
    }


def _currencies(star: _Star):
    return star.region, {"id": "r_regionkey", "currency_code": CURRENCY_OF_REGION}


def _forex_conversions(star: _Star):
    """The currency with number 4 has no rate."""
    return star.rates, {
        "id": "event_id",
        "from_currency_id": "user_id % 4",
        "date": "add_months(cast(ts as date), -276)",
        "value": "value",
    }


def _invoices(star: _Star):
    total = "cast(o_totalprice as decimal(18,2))"
    half = f"{total} - cast(floor(o_totalprice / 2) as decimal(18,2))"
    return star.orders, {
        "id": "o_orderkey",
        "project_id": "o_custkey",
        "po_id": "if(o_orderkey % 3 <> 0, o_orderkey div 8, null)",
        "invoice_code": "concat('IN', o_orderkey)",
        "total_amount": total,
        "balance_amount": f"case o_orderstatus when 'F' then 0 when 'P' then {half} else {total} end",
        "invoice_date": "o_orderdate",
        "status": "if(o_orderpriority = '4-NOT SPECIFIED', 'd', 'a')",
        "deleted": "if(o_orderkey % 17 = 0, 1, 0)",
        "invoice_reference": "case when o_orderkey % 13 = 0 and o_orderkey > 0 then o_orderkey - 1 when o_orderkey % 11 = 5 then 0 end",
        "consolidated_id": "if(o_orderkey % 10 = 0, o_orderkey - o_orderkey % 20, null)",
        "invoice_date_submission_customer": "if(o_orderkey % 2 = 0, date_add(cast(o_orderdate as date), 2), null)",
        "expected_collection_date": "if(o_orderkey % 5 = 0, date_add(cast(o_orderdate as date), 60), null)",
    }


def _invoice_consolidations(star: _Star):
    return star.orders.filter("o_orderkey % 20 = 0"), {"id": "o_orderkey"}


def _invoice_consolidation_details(star: _Star):
    """Some neighbours of a parent, and at times the parent itself."""
    return star.orders.filter("o_orderkey % 10 between 1 and 3 or o_orderkey % 30 = 0"), {
        "invoice_consolidation_id": "o_orderkey - o_orderkey % 20",
        "invoice_id": "o_orderkey",
    }


def _lines_per_order(star: _Star, flags: str, amount: str) -> DataFrame:
    lines = star.lineitem.filter(F.col("l_returnflag").isin(*flags)).selectExpr(
        "l_orderkey as o_orderkey", "l_shipdate", f"{amount} as amount"
    )
    return (
        lines.groupBy("o_orderkey")
        .agg({"amount": "sum", "l_shipdate": "max"})
        .withColumnsRenamed({"sum(amount)": "amount", "max(l_shipdate)": "day"})
    )


def _direct_invoices(star: _Star):
    lines = _lines_per_order(star, "NA", "cast(l_extendedprice as decimal(18,2))")
    return lines.join(star.order_place, "o_orderkey"), {
        "id": "o_orderkey",
        "customer_id": "c_custkey",
        "customer_code": "concat('C', c_custkey + if(o_orderkey % 19 = 0, 1, 0))",
        "po_no": "concat('DPO', o_orderkey)",
        "invoice_code": "concat('NI', o_orderkey - if(o_orderkey % 50 = 1, 1, 0))",
        "total_amount": "amount",
        "balance_amount": "amount",
        "invoice_date": "day",
        "credit_period": CREDIT_DAYS,
        "invoicing_currency_id": "n_regionkey",
        "project_name": "concat('Direct ', o_orderkey)",
        "rsh_id": f"(c_custkey + 3) % {OWNERS}",
        "bdm_id": f"c_custkey % {OWNERS}",
        "pm_id": f"(c_custkey + 5) % {OWNERS}",
        "sbu_id": "c_nationkey",
        "entity_id": "n_regionkey",
        "invoice_reference": "if(o_orderkey % 31 = 0 and o_orderkey > 0, o_orderkey - 1, null)",
        "deleted": "if(o_orderkey % 37 = 0, 1, 0)",
        "invoice_date_submission_customer": "if(o_orderkey % 2 = 0, date_add(cast(day as date), 2), null)",
        "expected_collection_date": "if(o_orderkey % 5 = 0, date_add(cast(day as date), 60), null)",
    }


def _credit_notes(star: _Star):
    amount = "cast(l_extendedprice as decimal(18,2)) * cast(l_discount as decimal(18,2))"
    return _lines_per_order(star, "R", amount).filter("round(amount, 2) > 0"), {
        "id": "o_orderkey",
        "mode_no": "concat('CN', o_orderkey)",
        "balance_amount": "round(amount, 2)",
        "date": "day",
        "deleted": "if(o_orderkey % 41 = 0, 1, 0)",
    }


def _credit_references(star: _Star):
    regions = star.region.withColumnRenamed("r_regionkey", "n_regionkey")
    return star.order_place.join(regions, "n_regionkey"), {
        "credit_note_id": "o_orderkey",
        "customer_no": "c_custkey",
        "currency": "if(n_regionkey = 0, 'INR', r_name)",
        "project_id": "c_custkey",
        "rsh_id": f"(c_custkey + 3) % {OWNERS}",
        "bdm_id": f"c_custkey % {OWNERS}",
        "sbu": "concat('NATION_', c_nationkey)",
        "entity": "r_name",
    }


def _project_purchase_orders(star: _Star):
    return star.part, {
        "id": "p_partkey",
        "attachment_reference_no": "case when p_size = 1 then '' when p_size <> 2 then concat('PO-', p_partkey) end",
        "is_primary": "if(p_size % 2 = 0, 1, 0)",
    }


def _po_so_masters(star: _Star):
    return star.part, {"po_id": "p_partkey", "sales_order_id": "p_partkey - p_partkey % 4"}


def _general_approvers(star: _Star):
    """Business heads per unit (function 4), and many people in copy per owner."""
    copies = "explode(if(n_nationkey % 3 = 0, array(0, 1), array(0))) as copy"
    heads = star.nation.selectExpr("n_nationkey", copies).selectExpr(
        "cast(n_nationkey * 2 + copy as long) as id",
        "n_nationkey as structure_id",
        "4L as function_id",
        f"concat('E', (n_nationkey + copy) % {OWNERS}) as employee_id",
        "if(copy = 0, 1, 0) as status",
    )
    in_copy = star.customer.selectExpr(
        "c_custkey + 1000 as id",
        "c_nationkey as structure_id",
        f"c_custkey % {OWNERS} + 100 as function_id",
        "concat('E', c_custkey div 10 % 12) as employee_id",
        "if(c_custkey % 3 <> 0, 1, 0) as status",
    )
    return heads.union(in_copy), {name: name for name in in_copy.columns}


def _company_structures(star: _Star):
    return star.nation, {"id": "n_nationkey", "name": "n_name"}


def _legal_entities(star: _Star):
    return star.region, {
        "id": "r_regionkey",
        "legal_entity": "r_name",
        "legal_entity_code": "substring(r_name, 1, 2)",
    }


def _debtor_reports(star: _Star):
    return star.customer, {"bdm_id": f"c_custkey % {OWNERS}"}


def _function_names(star: _Star):
    copy_lists = star.supplier.selectExpr(
        "s_suppkey + 100 as id", "'Mail' as type", f"concat('{CC_FUNCTION_PREFIX}e', s_suppkey) as name"
    )
    jobs = star.part.selectExpr(
        "p_partkey + 1000000000 as id",
        "if(p_partkey % 3 = 0, 'Web', 'Cron') as type",
        "concat('job_', p_partkey % 7) as name",
    )
    return copy_lists.union(jobs), {name: name for name in jobs.columns}


def _configuration_values(star: _Star):
    """Parents come from regions, their children from parts."""
    parents = star.region.selectExpr(
        "cast(r_regionkey as long) as id",
        "cast(null as long) as parent_id",
        "case r_regionkey when 0 then 'mail_details' when 1 then 'ar_mail_config'"
        " else concat('other_', r_name) end as configuration_key",
        "cast(null as string) as configuration_value",
    )
    children = star.part.selectExpr(
        "p_partkey + 100 as id",
        "p_partkey % 5 as parent_id",
        "case p_size when 1 then 'host' when 2 then 'port' when 3 then 'ar_username' when 4 then 'ar_from'"
        " when 5 then 'debtors_bdm_cron_bcc' else concat('key_', p_size) end as configuration_key",
        "case when p_partkey % 17 = 3 then null when p_size = 5 then concat('a', p_partkey, '@example.com, b@example.com,,')"
        " else concat(p_name, ' ', p_partkey) end as configuration_value",
    )
    return parents.union(children), {name: name for name in children.columns}


def _mail_configurations(star: _Star):
    return star.customer, {
        "id": "c_custkey",
        "function_id": "c_custkey % 5",
        "structure_id": "c_nationkey",
        "employee_id": "concat('E', c_custkey % 12)",
        "mail_to_type": (
            "case c_mktsegment when 'MACHINERY' then 'to' when 'BUILDING' then 'cc'"
            " when 'AUTOMOBILE' then 'bcc' else 'off' end"
        ),
    }


def _schedules(star: _Star):
    return star.customer, {
        "id": "c_custkey",
        "name": "concat('job_', c_custkey % 9)",
        "status": "if(c_custkey % 5 <> 0, 1, 0)",
        "hour": "c_custkey % 24",
        "minute": "c_custkey % 60",
        "dayofweek": "c_custkey % 7",
    }


EVENT_EPOCH = "unix_timestamp(cast(ts as timestamp))"
HOUR_EPOCH = "unix_timestamp(date_trunc('hour', cast(ts as timestamp)))"


def _scheduler_logs(star: _Star):
    return star.events, {
        "id": "event_id",
        "schedule_id": "user_id",
        "log": "event_type",
        "status": "if(event_type <> 'error', 1, 0)",
        "date_runned": EVENT_EPOCH,
        "date_cron": HOUR_EPOCH,
    }


_BUILDERS = {
    "invoices": _invoices,
    "invoice_consolidations": _invoice_consolidations,
    "invoice_consolidation_details": _invoice_consolidation_details,
    "direct_invoices": _direct_invoices,
    "credit_notes": _credit_notes,
    "credit_references": _credit_references,
    "projects": _projects,
    "project_so_masters": _project_so_masters,
    "sales_orders": _sales_orders,
    "project_purchase_orders": _project_purchase_orders,
    "po_so_masters": _po_so_masters,
    "customers": _customers,
    "customer_contacts": _customer_contacts,
    "currencies": _currencies,
    "forex_conversions": _forex_conversions,
    "employees": _employees,
    "general_approvers": _general_approvers,
    "company_structures": _company_structures,
    "legal_entities": _legal_entities,
    "debtor_reports": _debtor_reports,
    "function_names": _function_names,
    "configuration_values": _configuration_values,
    "mail_configurations": _mail_configurations,
    "schedules": _schedules,
    "scheduler_logs": _scheduler_logs,
}


def star_tables(spark: SparkSession, folder: str) -> Tables:
    """The receivables tables over one folder of test tables."""
    star = _Star(spark, folder)

    def read(name: str) -> DataFrame:
        rows, expressions = _BUILDERS[name](star)
        return _typed(rows, SCHEMAS[name], expressions)

    return Tables(read)


def star_run_events(spark: SparkSession, folder: str) -> DataFrame:
    """An append-only run log: three consecutive events make one run."""
    columns = {
        "run_id": "concat('run-', event_id - event_id % 3)",
        "schedule_id": "user_id",
        "event_ts": EVENT_EPOCH,
        "planned_ts": HOUR_EPOCH,
        "status": "if(event_type <> 'error', 1, 0)",
        "message": "event_type",
    }
    return _typed(_Star(spark, folder).events, RUN_EVENT_SCHEMA, columns)


def star_failures(spark: SparkSession, folder: str) -> DataFrame:
    """Failures of all three causes, with markup in their messages: web pages, some with an open tag at the end."""
    return _Star(spark, folder).pages.selectExpr(
        "page_id as failure_id",
        "case page_id % 3 when 0 then 'refused' when 1 then 'mailer' else 'other' end as cause",
        "if(page_id % 5 = 0, concat(html, '<a href=\"x'), html) as message",
    )
