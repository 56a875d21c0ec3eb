"""Reports for a table of days in one job, instead of one run for each day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duesight.operators.rates import asof_rate_by_day, holding_on
from duesight.settings import APPROVED_STATUS, MONEY_SUM
from duesight.sources.tables import Tables


def base_exposure_by_day(t: Tables, days: DataFrame) -> DataFrame:
    """Approved, unpaid invoices written up to each of ``days`` (a column ``report_date``) by the currency of their project, at
    the rate that was known on that day; no rate gives no base amount.

    Invoices are added up by project and day, then by currency and day, before a day is looked at. The running sum of
    a currency changes on few days and holds in between, so it meets the report days the same way as rates do.
    """
    unpaid = t.invoices.filter((F.col("balance_amount") > 0) & (F.col("status") == APPROVED_STATUS) & F.col("invoice_date").isNotNull())
    of_project = unpaid.groupBy("project_id", "invoice_date").agg(F.sum("balance_amount").cast(MONEY_SUM).alias("amount"))
    currencies = t.projects.selectExpr("id as project_id", "currency_id")
    written = of_project.join(currencies, "project_id").groupBy("currency_id", "invoice_date").agg(F.sum("amount").alias("amount"))
    by_day = Window.partitionBy("currency_id").orderBy("invoice_date")
    sums = written.select(
        "currency_id", F.col("invoice_date").alias("from_date"), F.lead("invoice_date").over(by_day).alias("to_date"),
        F.sum("amount").over(by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast(MONEY_SUM).alias("open_amount"),
    )
    amounts = holding_on(sums, days, "from_date", "to_date").drop("from_date", "to_date")
    rates = asof_rate_by_day(t.forex_conversions, days).drop("rate_date")
    base = (F.col("rate") * F.col("open_amount")).cast("decimal(38,8)").alias("base_amount")
    return amounts.join(rates, ["report_date", "currency_id"], "left").select("report_date", "currency_id", "open_amount", "rate", base)
