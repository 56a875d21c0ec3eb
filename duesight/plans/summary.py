"""Customer-by-currency summary with month buckets, read off one exposure table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duesight.functions.dates import (
    DUE_BUCKETS,
    FIXED_BUCKETS,
    UNPLACED,
    bucket_label,
    month_label,
    month_offset,
)
from duesight.functions.text import format_money
from duesight.operators.exposure import exposure
from duesight.operators.facts import beside_facts
from duesight.operators.rates import currency_table
from duesight.session import Stored
from duesight.settings import CON, CRN, DIR, INV, USUAL, SummaryOptions
from duesight.sources.tables import Tables

CUSTOMER_KEY = ("bdm_id", "customer_code", "currency_code")

# Which source names a customer: the first in this list that has the key. A credit note comes
# earlier where there is no currency.
LABEL_ORDER = (DIR, INV, CON, CRN)
LABEL_ORDER_WITHOUT_CURRENCY = (DIR, CRN, INV, CON)


def project_summary(t: Tables, as_of: dt.date, options: SummaryOptions = USUAL) -> DataFrame:
    """The project-invoice part alone. Its own due dates set the horizon, so it needs no other source."""
    currencies = currency_table(t, as_of, options.corrected_rates)
    rows = exposure(t, currencies, as_of, options.dedupe_orders, sources=[INV])
    return (
        rows.filter(F.col("customer_code").isNotNull() & (F.col("summary_count") > 0))
        .groupBy(*CUSTOMER_KEY, "bucket", "month_offset")
        .agg(F.sum("summary_amount").alias("amount"))
    )


def _rank(order: tuple[str, ...]) -> Column:
    return F.array_position(F.array(*map(F.lit, order)), F.col("source"))


class AgeingSummary:
    """The summary of all owners as of one day.

    All results are read off ``base``, which holds one row per owner, source, customer, currency
    and bucket. Summary, totals and report need it once: who is a candidate, the owner's horizon and
    the buckets to show are carried along with the rows (``_cells``, ``beside_facts``) and not joined back. Without a
    ``folder`` it is a plan, of which each result runs the sources it needs. With a
    folder that all executors share it is written there when the first result asks for it,
    and read by all; ``release``, or the end of a ``with`` block, deletes it.
    """

    def __init__(self, t: Tables, as_of: dt.date, options: SummaryOptions = USUAL, folder: str | None = None):
        self.as_of, self.options = as_of, options
        self._tables, self._folder = t, folder

    def _exposure(self, sources: Collection[str]) -> DataFrame:
        currencies = currency_table(self._tables, self.as_of, self.options.corrected_rates)
        return exposure(self._tables, currencies, self.as_of, self.options.dedupe_orders, sources)

    @cached_property
    def base(self) -> DataFrame:
        rows = self._exposure((INV, CON, DIR, CRN))
        if self._folder is None:
            return rows
        self._stored = Stored(rows, self._folder, "exposure")
        return self._stored.frame

    def _base_for(self, source: str | None) -> DataFrame:
        """What one source's rows need: those and the horizon's, and every source if candidates decide (``listed``)."""
        if source is None or source == DIR or self._folder is not None:
            return self.base
        return self._exposure({source, *self._horizon_sources})

    def release(self) -> None:
        """Delete the stored table; results that are not written yet can't be read afterwards."""
        if "_stored" in self.__dict__:
            self._stored.delete()
            del self._stored, self.__dict__["base"]

    def __enter__(self) -> AgeingSummary:
        return self

    def __exit__(self, *error) -> None:
        self.release()

    def candidate_customers(self) -> DataFrame:
        """Owner and code of every customer with an unsettled balance, of either sign."""
        return (
            self.base.select("bdm_id", F.col("candidate_code").alias("customer_code"))
            .filter(F.col("customer_code").isNotNull())
            .distinct()
        )

    @property
    def _horizon_sources(self) -> list[str]:
        return [INV, DIR, CON] if self.options.consolidated_horizon else [INV, DIR]

    def horizon(self) -> DataFrame:
        """Owner -> last due date of its invoices and how many future months the summary spans."""
        return (
            self.base.filter(F.col("source").isin(self._horizon_sources))
            .groupBy("bdm_id")
            .agg(F.max("last_due_date").alias("last_due_date"))
            .filter(F.col("last_due_date").isNotNull())
            .withColumn("months", F.greatest(month_offset(F.col("last_due_date"), self.as_of), F.lit(0)))
        )

    def listed_direct(self) -> DataFrame:
        """Unpaid amounts of stand-alone invoices of candidate customers, by customer and currency.

        A row of the other three sources is its own candidate: what is unpaid is
        unsettled, under the same code. Only a stand-alone invoice can carry a code
        that differs from its customer's.
        """
        rows = self._cells().filter(F.col("listed") & (F.col("source") == DIR) & (F.col("open_count") > 0))
        return rows.groupBy(*CUSTOMER_KEY).agg(F.sum("open_amount").alias("amount"))

    def _cells(self, source: str | None = None) -> DataFrame:
        """Sums per source, owner, customer code, currency and bucket, and whether the code is a candidate's.

        Each row counts under its customer's code and marks its candidate code, by a row of its own if that is spelled otherwise.
        Marks are added up to one row per owner and code, and a window over these two finds the rows whose code is
        marked. Codes that a collation compares are added up by spelling, and only the window compares them. It also finds the first of
        the customers' spellings, as plain text, which stands for all of them from here on.
        """
        rows = self._base_for(source)
        same = F.col("customer_code").cast("string").eqNullSafe(F.col("candidate_code").cast("string"))
        role = lambda code, own, marks: F.struct(F.col(code).alias("code"), F.lit(own).alias("own"), F.lit(marks).alias("marks"))
        codes = F.when(same, F.array(role("customer_code", True, True))).otherwise(F.array(role("customer_code", True, False), role("candidate_code", False, True)))
        roles = rows.select("*", F.inline(codes))
        own, in_summary, is_open = F.col("own"), F.col("own") & (F.col("summary_count") > 0), F.col("own") & (F.col("open_count") > 0)
        dated = own & F.col("source").isin(self._horizon_sources)
        rank = F.when(F.col("currency_code").isNull(), _rank(LABEL_ORDER_WITHOUT_CURRENCY)).otherwise(_rank(LABEL_ORDER))
        named = F.struct(rank.alias("rank"), F.coalesce("customer_name", F.lit("")).alias("name"))
        split = [F.when(own, F.col(name)).alias(name) for name in ("source", "bucket", "month_offset")]
        split.append(F.when(own, F.col("currency_code").cast("string")).alias("currency_code"))
        code_kind, currency_kind = (rows.schema[name].dataType for name in ("customer_code", "currency_code"))
        cells = roles.groupBy("bdm_id", F.col("code").cast("string").alias("customer_code"), *split).agg(
            F.sum(F.when(in_summary, F.col("summary_count"))).alias("summary_count"),
            F.sum(F.when(in_summary, F.col("summary_amount"))).alias("summary_amount"),
            F.sum(F.when(is_open, F.col("open_count"))).alias("open_count"),
            F.sum(F.when(is_open, F.col("open_amount"))).alias("open_amount"),
            F.sum(F.when(is_open, F.col("total_amount"))).alias("total_amount"),
            F.min(F.when(in_summary, named)).alias("named"),
            F.max(F.when(dated, F.col("last_due_date"))).alias("last_due_date"),
            F.max("marks").alias("marked"),
        )
        spelling = F.col("customer_code")
        of_code = Window.partitionBy("bdm_id", spelling.cast(code_kind))
        found = {"listed": spelling.isNotNull() & F.max("marked").over(of_code), "currency_code": F.col("currency_code").cast(currency_kind)}
        if code_kind != T.StringType():
            found["customer_code"] = F.coalesce(F.min(F.when(F.col("source").isNotNull(), spelling)).over(of_code), spelling)
        return cells.withColumns(found).drop("marked")

    def _placed(self, source: str | None = None) -> DataFrame:
        """Cells of candidates. Months past the owner's horizon have no bucket."""
        keys = ["source", *CUSTOMER_KEY, "bucket", "month_offset", "listed"]
        sums = [F.sum(name).alias(name) for name in ("summary_count", "summary_amount", "open_count", "total_amount")]
        more = [F.min("named").alias("named"), F.max("last_due_date").alias("last_due_date")]
        last_due = {"owner_last_due": lambda is_fact: F.max(F.when(is_fact, F.col("last_due_date")))}
        rows = beside_facts(self._cells(source), keys, [*sums, *more], ["bdm_id"], ["bdm_id"], last_due).filter("listed")
        months = F.greatest(F.coalesce(month_offset(F.col("owner_last_due"), self.as_of), F.lit(0)), F.lit(0))
        beyond = F.coalesce(F.col("month_offset") > months, F.lit(False))
        return rows.withColumns(
            {
                "bucket": F.when(beyond, UNPLACED).otherwise(F.col("bucket")),
                "month_offset": F.when(~beyond, F.col("month_offset")),
            }
        ).drop("listed", "last_due_date", "owner_last_due", "_part")

    def reported_owners(self) -> DataFrame:
        """Owners whose summary has a row."""
        return self._cells().filter(F.col("listed") & (F.col("summary_count") > 0)).select("bdm_id").distinct()

    def by_source(self, source: str | None = None) -> DataFrame:
        """Sums per owner, customer, currency and bucket, one set of rows per source; or of one ``source`` only."""
        wanted = F.col("summary_count") > 0
        return (
            self._placed(source)
            .filter(wanted if source is None else wanted & (F.col("source") == source))
            .groupBy("source", *CUSTOMER_KEY, "bucket", "month_offset")
            .agg(F.sum("summary_amount").alias("amount"))
        )

    def _net_sums(self) -> list[Column]:
        """Net sums per bucket, with what the label and the grand total need."""
        amount, is_credit = F.col("summary_amount"), F.col("source") == CRN
        signed = F.when(is_credit, -amount).otherwise(amount)
        cell = signed
        if self.options.future_credits_added:
            cell = F.when(F.col("month_offset") > 0, amount).otherwise(signed)
        in_summary = F.col("summary_count") > 0
        return [
            F.sum(F.when(in_summary, cell)).alias("net_amount"),
            F.sum(F.when(in_summary, F.when(F.col("bucket") != UNPLACED, signed).otherwise(0))).alias("placed_amount"),
            F.min("named").alias("named"),
        ]

    def _net(self) -> DataFrame:
        rows = self._placed().filter(F.col("summary_count") > 0)
        return rows.groupBy(*CUSTOMER_KEY, "bucket", "month_offset").agg(*self._net_sums())

    def merged(self) -> DataFrame:
        """Net amount per owner, customer, currency and bucket over all sources."""
        return self._net().select(*CUSTOMER_KEY, "bucket", "month_offset", "net_amount")

    def wide(self, months: int | None = None) -> DataFrame:
        """One column per bucket and ``months`` future months, or as many as the farthest horizon needs."""
        if months is None:
            months = self.horizon().agg(F.max("months")).first()[0] or 0
        buckets = [*FIXED_BUCKETS, *[f"p{offset}" for offset in range(1, months + 1)]]
        return self.merged().groupBy(*CUSTOMER_KEY).pivot("bucket", buckets).agg(F.sum("net_amount"))

    def _customers(self, net: DataFrame, *more: str) -> DataFrame:
        """One row per owner, customer and currency; ``future`` has an entry per month at most."""
        cell = F.struct("month_offset", "bucket", "net_amount")
        label = F.concat(F.col("customer_code"), F.lit(" - "), F.min("named")["name"])
        fixed = [
            F.sum(F.when(F.col("bucket") == name, F.col("net_amount"))).alias(name) for name in FIXED_BUCKETS
        ]
        return (
            net.groupBy(*CUSTOMER_KEY, *more)
            .agg(
                label.alias("customer_label"),
                F.sum("placed_amount").alias("grand_total"),
                *fixed,
                F.array_sort(F.collect_list(F.when(F.col("month_offset") > 0, cell))).alias("future"),
            )
        )

    def grand_total(self) -> DataFrame:
        """Net of all buckets, shown or not; credits always reduce it."""
        return self._customers(self._net()).select(*CUSTOMER_KEY, "customer_label", "grand_total")

    def bucket_totals(self) -> DataFrame:
        """Per owner, source and bucket the sum that decides whether a column is shown.

        It mixes converted and unconverted money and adds credits, so it is no amount
        to publish.
        """
        return (
            self._placed()
            .filter((F.col("open_count") > 0) & (F.col("bucket") != UNPLACED))
            .groupBy("bdm_id", "source", "bucket", "month_offset")
            .agg(F.coalesce(F.sum("total_amount"), F.lit(0)).cast("decimal(38,8)").alias("total"))
        )

    def visible_buckets(self) -> DataFrame:
        """Buckets an owner's summary shows: those whose total does not print as empty."""
        bucket, offset = F.col("bucket"), F.col("month_offset")
        return (
            self.bucket_totals()
            .groupBy("bdm_id", "bucket", "month_offset")
            .agg(format_money(F.sum("total").cast("decimal(38,8)")).alias("total_text"))
            .filter(F.col("total_text") != "")
            .select(
                "bdm_id",
                "bucket",
                "month_offset",
                bucket_label(bucket, offset, self.as_of).alias("label"),
                F.when(bucket.isin(*DUE_BUCKETS), "due").otherwise("not_due").alias("section"),
                "total_text",
            )
        )

    def visible_spans(self) -> DataFrame:
        """How many due and not-due columns an owner's summary has."""
        section = F.col("section")
        return (
            self.visible_buckets()
            .groupBy("bdm_id")
            .agg(
                F.count_if(section == "due").alias("due_columns"),
                F.count_if(section == "not_due").alias("not_due_columns"),
            )
        )

    def report(self) -> DataFrame:
        """The printed summary. A hidden column is NULL, a shown but empty cell is ``''``.

        Future months, of which every owner has a different number, come as one text
        of ``month=amount`` entries; ``wide`` gives them as columns.
        """
        total = F.sum(F.when((F.col("open_count") > 0) & (F.col("bucket") != UNPLACED), F.col("total_amount")))
        sums = [*self._net_sums(), F.sum("summary_count").alias("summary_count"), total.cast("decimal(38,8)").alias("total")]

        def shown(is_fact: Column) -> Column:
            printed = format_money(F.col("total")) != ""
            return F.collect_list(F.when(is_fact & printed, F.col("bucket")))

        # The totals of an owner's buckets come out of the pass that adds up the cells.
        bucket = ["bucket", "month_offset"]
        cells = beside_facts(self._placed(), [*CUSTOMER_KEY, *bucket], sums, ["bdm_id", *bucket], ["bdm_id"], {"shown": shown}, CUSTOMER_KEY)
        customers = self._customers(cells.filter(F.col("summary_count") > 0), "_part", "shown")
        currency = F.col("currency_code")

        def is_shown(bucket: Column) -> Column:
            return F.coalesce(F.array_contains(F.col("shown"), bucket), F.lit(False))

        def cell(name: str) -> Column:
            text = format_money(F.coalesce(F.col(f"`{name}`"), F.lit(0)), currency)
            return F.when(is_shown(F.lit(name)), text).alias(name.replace("-", ""))

        # Months are turned into text first, so that each amount is formatted once.
        texts = F.transform(
            F.filter("future", lambda item: is_shown(item["bucket"])),
            lambda item: F.struct(
                month_label(item["month_offset"], self.as_of).alias("label"),
                format_money(item["net_amount"], currency).alias("text"),
            ),
        )
        printed = F.transform(
            F.filter(texts, lambda month: month["text"] != ""),
            lambda month: F.concat(month["label"], F.lit("="), month["text"]),
        )
        return customers.select(
            *CUSTOMER_KEY,
            "customer_label",
            *[cell(name) for name in FIXED_BUCKETS],
            F.array_join(printed, "; ").alias("future_months"),
            format_money(F.col("grand_total"), currency).alias("grand_total"),
        )
