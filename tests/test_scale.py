"""Plans and results when nothing can be broadcast and one key holds a third of all rows."""

from __future__ import annotations

import contextlib

import pytest
from pyspark.sql import functions as F

from duesight.operators.documents import consolidation_routes, open_invoices
from duesight.operators.exposure import exposure
from duesight.operators.lookup import left_lookup
from duesight.operators.rates import currency_table
from duesight.operators.routes import summary_routes
from duesight.plans.open_items import project_items
from duesight.plans.people import config_map
from duesight.plans.runlog import latest_run
from duesight.sources.schemas import SCHEMAS
from duesight.sources.tables import file_tables
from tests.conftest import AS_OF, hand_tables

INVOICES = 60_000
PROJECTS = 2_000


@contextlib.contextmanager
def settings(spark, **values):
    names = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """Project 0 holds a third of the invoices, and one invoice is named as revised by very many."""
    folder = tmp_path_factory.mktemp("skewed")
    hot = F.expr(f"if(id % 3 = 0, 0, id % {PROJECTS})")
    invoices = spark.range(0, INVOICES, numPartitions=8).select(
        "id",
        hot.alias("project_id"),
        F.expr("if(id % 2 = 0, null, id div 4)").alias("po_id"),
        F.expr("concat('IN', id)").alias("invoice_code"),
        F.expr("cast(id % 97 as decimal(18,2))").alias("total_amount"),
        F.expr("cast(id % 97 as decimal(18,2))").alias("balance_amount"),
        F.expr("date_add(date '2001-01-01', cast(id % 150 as int))").alias("invoice_date"),
        F.lit("a").alias("status"),
        F.lit(0).alias("deleted"),
        F.expr("if(id % 5 = 4, 1L, null)").alias("invoice_reference"),
        F.expr("if(id % 10 = 0, id % 40, null)").alias("consolidated_id"),
        F.lit(None).cast("date").alias("invoice_date_submission_customer"),
        F.lit(None).cast("date").alias("expected_collection_date"),
    )
    key = F.col("id")
    frames = {
        "invoices": invoices,
        "projects": spark.range(PROJECTS).selectExpr(
            "id", "concat('P', id) as project_code", "'p' as project_name", "1L as currency_id", "1L as project_manager"
        ),
        "project_so_masters": spark.range(PROJECTS).select(key.alias("project_id"), key.alias("sales_order_id")),
        "sales_orders": spark.range(PROJECTS).selectExpr(
            "id", "concat('S', id) as sales_order_code", "10 as credit_period", "id as customer_id",
            "id as finance_contact_id", "1L as rsh_id", "id % 3 as sales_person_id", "1L as sbu", "1L as currency_id",
            "1L as legal_entity_id",
        ),
        "customers": spark.range(PROJECTS).selectExpr(
            "id", "concat('C', id) as customer_code", "'n' as customer_name", "'d' as division"
        ),
        "employees": spark.range(3).selectExpr(
            "id", "concat('E', id) as employee_number", "'a' as first_name", "'b' as last_name",
            "'m' as work_email_address", "'u' as structure_name", "'c' as employment_status",
        ),
        "currencies": spark.createDataFrame([(1, "INR")], SCHEMAS["currencies"]),
        "project_purchase_orders": spark.range(INVOICES // 4).selectExpr(
            "id", "concat('PO', id) as attachment_reference_no", "1 as is_primary"
        ),
    }
    empty = hand_tables(spark)
    for name in SCHEMAS:
        (frames.get(name) if name in frames else getattr(empty, name)).write.parquet(str(folder / name))
    return file_tables(spark, str(folder))


NO_BROADCAST = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__coalescePartitions__enabled": "false",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20000",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20000",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
    "spark__sql__shuffle__partitions": "16",
}


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_project_is_split_in_the_row_level_join(spark, skewed):
    with settings(spark, **NO_BROADCAST):
        items = project_items(skewed, currency_table(skewed, AS_OF))
        assert "SortMergeJoin(skew=true)" in final_plan(items)
        expected = open_invoices(skewed).count()
        assert items.count() == expected > INVOICES / 2


def test_hot_project_is_added_up_before_the_summary_joins_it(spark, skewed):
    with settings(spark, **NO_BROADCAST):
        rows = exposure(skewed, currency_table(skewed, AS_OF), AS_OF, sources=["INV"])
        plan = final_plan(rows)
    final = plan[: plan.index("Initial Plan")]
    join, scan = final.index("SortMergeJoin"), final.index("invoice_date")
    assert final.index("partial_sum(CASE WHEN (balance_amount") > join
    assert scan > 0 and "SortMergeJoin(skew=true) [project_id" not in final
    total = rows.agg(F.sum("open_amount"), F.sum("open_count")).first()
    check = skewed.invoices.filter("balance_amount > 0").agg(F.sum("balance_amount"), F.count("*")).first()
    assert tuple(total) == tuple(check)


def test_one_much_revised_invoice_is_one_row(spark, skewed):
    plan = open_invoices(skewed)._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "HashAggregate(keys=[id" in plan
    assert open_invoices(skewed).filter("id = 1").count() == 0


def test_dedupe_keeps_one_row_per_key_and_task_before_the_shuffle(skewed):
    plan = consolidation_routes(skewed)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit [consolidated_id" in plan and ", Partial" in plan


def test_no_lookup_is_broadcast_against_the_thresholds(spark, skewed):
    currencies = spark.range(200_001).selectExpr("id as currency_id", "concat('X', id) as currency_code", "cast(1 as decimal(18,6)) as rate")
    with settings(spark, **NO_BROADCAST):
        plan = summary_routes(skewed, currencies)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan


def test_purchase_orders_meet_narrow_rows(spark, skewed):
    """The shuffle of invoices by purchase order carries no project or customer text."""
    with settings(spark, **NO_BROADCAST):
        plan = project_items(skewed, currency_table(skewed, AS_OF))._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    routed = next(i for i, line in enumerate(lines) if "Join [project_id" in line)
    keyed = next(i for i, line in enumerate(lines) if "hashpartitioning(_key" in line)
    assert keyed > routed and depth(lines[keyed]) > depth(lines[routed])


def test_log_and_configuration_are_hashed(cases):
    for frame in (latest_run(cases), config_map(cases)):
        assert "SortAggregate" not in frame._jdf.queryExecution().executedPlan().toString()


def test_null_keys_are_spread(spark):
    rows = spark.range(4000).selectExpr("id as doc_id", "if(id % 2 = 0, null, id % 10) as k")
    table = spark.range(10).selectExpr("id as k", "concat('v', id) as v")
    with settings(spark, **NO_BROADCAST):
        joined = left_lookup(rows, table, "k", "doc_id")
        sizes = [r["count"] for r in joined.filter("k is null").groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 2000 and max(sizes) < 400
    assert joined.filter("v is not null").count() == 2000 and joined.columns == ["doc_id", "k", "v"]
