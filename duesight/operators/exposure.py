"""Balances added up before anything is joined to them.

A due date needs the document's date and its project's (or customer's) credit
days, nothing else. So documents collapse to one row per project and day first:
a project that holds a third of all documents becomes as many rows as there are
days, spread over all tasks, and the joins that follow see no hot key.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duesight.functions.dates import RECENT, ageing_bucket, bucket_name, due_date, month_offset
from duesight.operators.documents import unpaid_credits
from duesight.operators.routes import in_owner_slots, of_owned_projects, of_owners, owned_orders, summary_routes
from duesight.settings import APPROVED_STATUS, CON, CRN, DIR, INV, MONEY, MONEY_SUM, RATE
from duesight.sources.tables import Tables

MEASURES = ("open_count", "open_amount", "summary_count", "summary_amount")
KEYS = ("bdm_id", "source", "candidate_code", "customer_code", "customer_name", "currency_code")


def _measures(is_open: Column, in_summary: Column, amount: Column) -> list[Column]:
    """Counts and sums of what is unpaid, and of the part of it the summary shows."""
    one = F.lit(1)
    return [
        F.sum(F.when(is_open, one).otherwise(0)).alias("open_count"),
        F.sum(F.when(is_open, amount).otherwise(0)).cast(MONEY_SUM).alias("open_amount"),
        F.sum(F.when(in_summary, one).otherwise(0)).alias("summary_count"),
        F.sum(F.when(in_summary, amount).otherwise(0)).cast(MONEY_SUM).alias("summary_amount"),
    ]


def _by_spelling(rows: DataFrame, keys: Collection[str]) -> tuple[list[Column], list[Column]]:
    """Keys to group by and keys of the result. Collated text is grouped by its spelling, which Spark can hash; what is equal under the
    collation meets in the summary, when documents are added up. The result has the collation again."""
    kinds = {name: rows.schema[name].dataType for name in keys}
    kinds = {name: kind for name, kind in kinds.items() if isinstance(kind, T.StringType) and kind != T.StringType()}
    plain = [F.col(name).cast("string").alias(name) if name in kinds else F.col(name) for name in keys]
    return plain, [F.col(name).cast(kinds[name]).alias(name) if name in kinds else F.col(name) for name in keys]


def _project_days(t: Tables) -> DataFrame:
    unpaid = F.col("balance_amount") > 0
    approved = unpaid & (F.col("status") == APPROVED_STATUS)
    return (
        of_owned_projects(t, t.invoices.filter(F.col("balance_amount") != 0))
        .groupBy("project_id", "invoice_date")
        .agg(*_measures(unpaid, approved, F.col("balance_amount")))
        .selectExpr("*", "cast(null as date) as parent_date", f"'{INV}' as source")
    )


def parent_counts(t: Tables) -> DataFrame:
    """Consolidation -> how many of its parent invoices are unsettled, unpaid, and approved."""
    unpaid = F.col("balance_amount") > 0
    approved = unpaid & (F.col("status") == APPROVED_STATUS) & (F.col("deleted") == 0)
    known = t.invoice_consolidations.withColumnRenamed("id", "consolidated_id")
    return (
        t.invoices.filter(F.col("consolidated_id").isNotNull() & (F.col("balance_amount") != 0))
        .groupBy("consolidated_id")
        .agg(
            F.sum(F.when(unpaid, 1).otherwise(0)).alias("open_parents"),
            F.sum(F.when(approved, 1).otherwise(0)).alias("approved_parents"),
            F.max(F.when(unpaid, F.col("invoice_date"))).alias("parent_date"),
        )
        .join(known, "consolidated_id", "left_semi")
    )


def consolidation_balances(t: Tables) -> DataFrame:
    """Consolidation -> its unpaid parents, its constituents, and the balance of all their pairs."""
    parents = parent_counts(t).filter(F.col("open_parents") > 0)
    members = (
        t.invoice_consolidation_details.withColumnsRenamed(
            {"invoice_consolidation_id": "consolidated_id", "invoice_id": "id"}
        )
        .join(t.invoices.select("id", "balance_amount"), "id")
        .groupBy("consolidated_id")
        .agg(F.count(F.lit(1)).alias("constituents"), F.sum("balance_amount").alias("balance"))
    )
    paired = F.coalesce("balance", F.lit(0)).cast(MONEY_SUM) * F.col("open_parents").cast("decimal(12,0)")
    return parents.join(members, "consolidated_id", "left").select(
        "consolidated_id",
        F.col("open_parents").alias("parents"),
        F.coalesce("constituents", F.lit(0)).alias("constituents"),
        paired.alias("paired_balance"),
    )


def invoice_buckets(t: Tables, as_of: dt.date) -> DataFrame:
    """Due date, month offset and bucket of every approved, unpaid invoice and sales order."""
    unpaid = t.invoices.filter((F.col("balance_amount") > 0) & (F.col("status") == APPROVED_STATUS))
    orders = owned_orders(t).select("project_id", "bdm_id", "sales_order_id", "credit_period")
    due = F.col("due_date")
    return (
        unpaid.join(orders, "project_id")
        .withColumn("due_date", due_date(F.col("invoice_date"), F.col("credit_period")))
        .select(
            "bdm_id",
            F.col("id").alias("doc_id"),
            "sales_order_id",
            "due_date",
            month_offset(due, as_of).alias("month_offset"),
            ageing_bucket(due, as_of).alias("bucket"),
        )
    )


def _constituent_days(t: Tables) -> DataFrame:
    """Constituents weighted by the number of parents, so pairs are counted but never built."""
    weights = (
        t.invoice_consolidation_details.withColumnRenamed("invoice_consolidation_id", "consolidated_id")
        .join(parent_counts(t), "consolidated_id")
        .groupBy(F.col("invoice_id").alias("id"))
        .agg(
            F.sum("open_parents").alias("open_parents"),
            F.sum("approved_parents").alias("approved_parents"),
            F.max("parent_date").alias("parent_date"),
        )
    )
    constituents = of_owned_projects(t, t.invoices).select("id", "project_id", "invoice_date", "balance_amount")
    weighted = constituents.join(weights, "id")

    def times(parents: str) -> Column:
        return F.coalesce("balance_amount", F.lit(0)).cast(MONEY) * F.col(parents).cast("decimal(12,0)")

    days = weighted.groupBy("project_id", "invoice_date").agg(
        F.sum("open_parents").alias("open_count"),
        F.sum(times("open_parents")).cast(MONEY_SUM).alias("open_amount"),
        F.sum("approved_parents").alias("summary_count"),
        F.sum(times("approved_parents")).cast(MONEY_SUM).alias("summary_amount"),
        F.max("parent_date").alias("parent_date"),
    )
    return days.withColumn("source", F.lit(CON))


def _project_rows(t: Tables, currencies: DataFrame, days: DataFrame, dedupe: bool) -> DataFrame:
    """Days of projects with owner, customer and due date."""
    routed = days.join(summary_routes(t, currencies, dedupe), "project_id")
    due = due_date(F.col("invoice_date"), F.col("credit_days"))
    parent_due = due_date(F.col("parent_date"), F.col("credit_days"))
    return (
        routed.withColumn("due_date", due)
        .withColumn("candidate_code", F.col("customer_code"))
        .withColumn("horizon_date", F.when(F.col("source") == CON, parent_due).otherwise(due))
    )


def _direct_days(t: Tables, currencies: DataFrame) -> DataFrame:
    unpaid = F.col("balance_amount") > 0
    unsettled = t.direct_invoices.filter((F.col("balance_amount") != 0) & F.col("bdm_id").isNotNull())
    rows = of_owners(t, in_owner_slots(t, unsettled)).select(
        "bdm_id",
        "customer_id",
        F.col("customer_code").alias("candidate_code"),
        F.col("invoicing_currency_id").alias("currency_id"),
        due_date(F.col("invoice_date"), F.col("credit_period")).alias("due_date"),
        "balance_amount",
    )
    plain, keys = _by_spelling(rows, ("bdm_id", "customer_id", "candidate_code", "currency_id", "due_date"))
    days = rows.groupBy(*plain).agg(*_measures(unpaid, unpaid, F.col("balance_amount"))).select(*keys, *MEASURES)
    return days.join(currencies, "currency_id", "left").withColumn("source", F.lit(DIR))


def _credit_days(t: Tables) -> DataFrame:
    always = F.lit(True)
    rows = unpaid_credits(t).select(
        "bdm_id",
        F.col("customer_no").alias("customer_id"),
        F.col("currency").alias("currency_code"),
        F.col("date").alias("due_date"),
        "balance_amount",
    )
    plain, keys = _by_spelling(rows, ("bdm_id", "customer_id", "currency_code", "due_date"))
    days = rows.groupBy(*plain).agg(*_measures(always, always, F.col("balance_amount"))).select(*keys, *MEASURES)
    # Its candidate code is its customer's, which is not known yet; a code's type may carry a collation.
    no_code = F.lit(None).cast(t.customers.schema["customer_code"].dataType)
    return days.withColumn("candidate_code", no_code).selectExpr("*", f"'{CRN}' as source", f"cast(null as {RATE}) as rate")


def _customer_rows(t: Tables, days: DataFrame) -> DataFrame:
    """Days of documents that name their customer themselves."""
    customers = t.customers.selectExpr("id as customer_id", "customer_code", "customer_name")
    joined = days.join(customers, "customer_id", "left")
    own_code = F.when(F.col("source") == DIR, F.col("candidate_code")).otherwise(F.col("customer_code"))
    return joined.withColumn("candidate_code", own_code).withColumn("horizon_date", F.col("due_date"))


def _by_bucket(rows: DataFrame, as_of: dt.date) -> DataFrame:
    """Collapse routed rows to buckets.

    Rows are grouped by their month, with all months before the recent ones as
    one, and buckets get their names afterwards. ``total_amount`` is what the
    column totals add up: invoices are converted up to the current month and taken
    as they are in later ones, the other two sources are never converted.
    """
    due, offset, amount = F.col("due_date"), F.col("month_offset"), F.col("open_amount")
    oldest = F.lit(min(RECENT) - 1)
    months = rows.withColumns(
        {
            "month_offset": F.when(due.isNotNull(), F.greatest(month_offset(due, as_of), oldest)),
            "overdue": due < F.lit(as_of),
        }
    )
    converted = F.col("source").isin(INV, DIR) & (F.coalesce(offset, F.lit(0)) <= 0)
    total = F.when(converted, F.col("rate") * amount).otherwise(amount).cast("decimal(38,8)")
    plain, keys = _by_spelling(months, KEYS)
    return (
        months.groupBy(*plain, "month_offset", "overdue")
        .agg(
            F.sum("open_count").alias("open_count"),
            F.sum("open_amount").cast(MONEY_SUM).alias("open_amount"),
            F.sum("summary_count").alias("summary_count"),
            F.sum("summary_amount").cast(MONEY_SUM).alias("summary_amount"),
            F.sum(total).cast("decimal(38,8)").alias("total_amount"),
            F.max(F.when(F.col("open_count") > 0, F.col("horizon_date"))).alias("last_due_date"),
        )
        .withColumn("bucket", bucket_name(offset, F.col("overdue")))
        .select(*keys, "month_offset", *MEASURES, "total_amount", "last_due_date", "bucket")
    )


def exposure(
    t: Tables,
    currencies: DataFrame,
    as_of: dt.date,
    dedupe: bool = False,
    sources: Collection[str] = (INV, CON, DIR, CRN),
) -> DataFrame:
    """Balances by owner, source, customer, currency and bucket.

    Candidates, horizon, summaries and column totals are all read off this one
    small table. Codes that a collation takes for equal have a row for each spelling. To make it, invoices are read three times (as documents, as parents
    and as constituents) and the other document tables once.
    """

    def union(parts: list[DataFrame]) -> DataFrame:
        return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts)

    parts = []
    projects = [days(t) for source, days in ((INV, _project_days), (CON, _constituent_days)) if source in sources]
    if projects:
        parts.append(_project_rows(t, currencies, union(projects), dedupe))
    direct = [_direct_days(t, currencies)] if DIR in sources else []
    credits = [_credit_days(t)] if CRN in sources else []
    if direct or credits:
        parts.append(_customer_rows(t, union(direct + credits)))
    columns = [*KEYS, "due_date", "horizon_date", "rate", *MEASURES]
    rows = union([part.select(*[name for name in columns if name in part.columns]) for part in parts])
    return _by_bucket(rows, as_of)
