"""The registered queries: the Spark job and, next to it, the SQL that checks it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duesight.checks.oracle import AS_OF, RATE_AS_OF, statement
from duesight.functions import dates
from duesight.functions.text import format_money
from duesight.operators import documents, exposure
from duesight.operators.rates import asof_rate, asof_rate_by_day, currency_table, latest_rate
from duesight.plans import back_run, detail_sheet, notify, open_items, people, runlog
from duesight.plans.summary import AgeingSummary, project_summary
from duesight.session import Stored, prepare, shared_folder
from duesight.settings import DEFAULT_AS_OF, USUAL, SummaryOptions
from duesight.sources.owner_layout import store_by_owner
from duesight.sources.run_log import RunLog
from duesight.sources.sinks import HandOff, SheetStore
from duesight.sources.starmap import star_failures, star_run_events, star_tables
from duesight.sources.tables import Tables, collated

# Error texts, module, function, key and sender names that the SQL below spells out are those of the settings.
RATE_DAY = dt.date.fromisoformat(RATE_AS_OF)
# A Saturday morning, so that weekday 6 is today's.
NOW = dt.datetime(2001, 6, 16, 9, 30, 15)

MONTH_END = dt.date(2001, 2, 28)

DEDUPED = SummaryOptions(dedupe_orders=True)
CREDITS_ADDED = SummaryOptions(future_credits_added=True)
LONG_HORIZON = SummaryOptions(consolidated_horizon=True)


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


REGISTRY: dict[str, Query] = {}


def plain(df: DataFrame) -> DataFrame:
    """Display types: money as double with two places, dates as text."""
    columns = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = F.round(column, 2).cast("double")
        elif isinstance(field.dataType, T.DateType) or (isinstance(field.dataType, T.StringType) and field.dataType != T.StringType()):
            column = column.cast("string")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def query(name: str, sql: str | None = None, **statement_options: str):
    """Register a job that takes the tables; ``sql`` selects from the oracle's views."""

    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain(build(star_tables(prepare(spark), folder)))

        REGISTRY[name] = Query(run, statement(sql, **statement_options) if sql else None)
        return build

    return register


def _money(*names: str) -> str:
    return ", ".join(f"round({name}, 2)::DOUBLE AS {name}" for name in names)


def _day(*names: str) -> str:
    return ", ".join(f"{name}::DATE::VARCHAR AS {name}" for name in names)


def _currencies(t: Tables) -> DataFrame:
    return currency_table(t, DEFAULT_AS_OF)


def _summary(t: Tables, options: SummaryOptions = USUAL, as_of: dt.date = DEFAULT_AS_OF) -> AgeingSummary:
    return AgeingSummary(t, as_of, options)


# --- rates -----------------------------------------------------------------------------------


@query("latest_rate", f"SELECT currency_id, {_money('rate')}, {_day('rate_date')} FROM rates")
def _(t: Tables) -> DataFrame:
    return latest_rate(t.forex_conversions, DEFAULT_AS_OF)


@query(
    "asof_rate",
    f"""SELECT from_currency_id AS currency_id, round(value, 2)::DOUBLE AS rate, date::VARCHAR AS rate_date
    FROM forex_conversions WHERE date <= DATE '{RATE_AS_OF}'
    QUALIFY row_number() OVER (PARTITION BY from_currency_id ORDER BY date DESC, id DESC) = 1""",
)
def _(t: Tables) -> DataFrame:
    return asof_rate(t.forex_conversions, RATE_DAY)


@query(
    "asof_rate_by_day",
    f"""SELECT report_date::VARCHAR AS report_date, from_currency_id AS currency_id, {_money('value')}, date::VARCHAR AS rate_date
    FROM (SELECT DISTINCT invoice_date AS report_date FROM invoices) JOIN forex_conversions ON date <= report_date
    QUALIFY row_number() OVER (PARTITION BY report_date, from_currency_id ORDER BY date DESC, id DESC) = 1""".replace("AS value", "AS rate"),
)
def _(t: Tables) -> DataFrame:
    """Every day on which an invoice was written is a report day."""
    return asof_rate_by_day(t.forex_conversions, t.invoices.select(F.col("invoice_date").alias("report_date")))


@query(
    "base_exposure_by_day",
    f"""SELECT a.report_date::VARCHAR AS report_date, a.currency_id, a.open_amount::DOUBLE AS open_amount, {_money('rate')},
        round(rate * a.open_amount, 2)::DOUBLE AS base_amount
    FROM (SELECT d.report_date, p.currency_id, sum(i.balance_amount)::DECIMAL(23,2) AS open_amount
          FROM (SELECT DISTINCT invoice_date AS report_date FROM invoices WHERE invoice_date >= DATE '2001-01-01') d
          JOIN invoices i ON i.invoice_date <= d.report_date JOIN projects p ON p.id = i.project_id
          WHERE i.balance_amount > 0 AND i.status = 'a' GROUP BY 1, 2) a
    LEFT JOIN (SELECT report_date, from_currency_id AS currency_id, value AS rate
               FROM (SELECT DISTINCT invoice_date AS report_date FROM invoices) JOIN forex_conversions ON date <= report_date
               QUALIFY row_number() OVER (PARTITION BY report_date, from_currency_id ORDER BY date DESC, id DESC) = 1) r
      ON r.report_date = a.report_date AND r.currency_id = a.currency_id""",
)
def _(t: Tables) -> DataFrame:
    """A back run over the days since 2001."""
    days = t.invoices.select(F.col("invoice_date").alias("report_date")).filter("report_date >= date'2001-01-01'")
    return back_run.base_exposure_by_day(t, days)


# --- documents -------------------------------------------------------------------------------


@query(
    "revision_filter",
    """SELECT i.id AS doc_id FROM invoices i LEFT JOIN invoices child ON child.invoice_reference = i.id
    WHERE i.status = 'a' AND i.deleted = 0 AND i.balance_amount > 0 AND coalesce(i.invoice_reference, 0) = 0
      AND child.id IS NULL""",
)
def _(t: Tables) -> DataFrame:
    return documents.open_invoices(t).select(F.col("id").alias("doc_id"))


@query("dedupe_fanout", "SELECT bdm_id, doc_id, sales_order_id FROM items_inv")
def _(t: Tables) -> DataFrame:
    return documents.invoice_orders(t).drop("po_id")


@query("po_resolution", "SELECT bdm_id, doc_id, po_no FROM items_inv")
def _(t: Tables) -> DataFrame:
    return open_items.purchase_orders(t)


@query(
    "consolidated_items",
    """SELECT cp.parent_consolidation AS consolidated_id, count(DISTINCT cp.parent_id) AS parents,
           count(DISTINCT i.id) AS constituents, coalesce(sum(i.balance_amount), 0)::DOUBLE AS paired_balance
    FROM con_pairs cp LEFT JOIN invoices i ON i.id = cp.constituent_id
    WHERE cp.parent_balance > 0 GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    return exposure.consolidation_balances(t)


ITEM_TEXT = ", ".join(
    name
    for name in open_items.ITEM_COLUMNS
    if name not in ("amount", "balance", "balance_base", "invoice_date", "due_date", "submitted_on", "expected_on")
)
ITEM_SQL = (
    f"SELECT {ITEM_TEXT}, {_money('amount', 'balance', 'balance_base')},"
    f" {_day('invoice_date', 'due_date', 'submitted_on', 'expected_on')} FROM "
)


@query("open_items_inv", ITEM_SQL + "items_inv")
def _(t: Tables) -> DataFrame:
    return open_items.project_items(t, _currencies(t))


@query("open_items_con", ITEM_SQL + "items_con")
def _(t: Tables) -> DataFrame:
    return open_items.consolidated_items(t, _currencies(t))


@query("open_items_dir", ITEM_SQL + "items_dir")
def _(t: Tables) -> DataFrame:
    return open_items.direct_items(t, _currencies(t))


@query("open_items_crn", ITEM_SQL + "items_crn")
def _(t: Tables) -> DataFrame:
    return open_items.credit_items(t, _currencies(t))


@query("open_items", ITEM_SQL + "items")
def _(t: Tables) -> DataFrame:
    return open_items.open_items(t, DEFAULT_AS_OF)


@query("open_items_of_owners", ITEM_SQL + "items WHERE bdm_id % 5 = 2")
def _(t: Tables) -> DataFrame:
    """A run for some owners over documents laid out by owner."""
    stored = store_by_owner(t, shared_folder(t.invoices.sparkSession), slots=16)
    chosen = t.debtor_reports.filter("bdm_id % 5 = 2")
    return open_items.open_items(stored.of_owners(chosen), DEFAULT_AS_OF)


@query("open_items_corrected_rates", ITEM_SQL + "items", as_of=RATE_AS_OF, rate_rows="known_rate")
def _(t: Tables) -> DataFrame:
    return open_items.open_items(t, RATE_DAY, corrected_rates=True)


@query(
    "detail_sheet",
    """SELECT bdm_id, doc_key, customer_label AS customer_name, doc_no AS invoice_number,
        strftime(invoice_date, '%d-%b-%Y') AS invoice_date, strftime(due_date, '%d-%b-%Y') AS due_date,
        currency_code AS invoicing_currency,
        CASE WHEN sign < 0 THEN '(' || amount::DECIMAL(18,2) || ')' ELSE amount::DECIMAL(18,2)::VARCHAR END
            AS amount_in_ic,
        CASE WHEN sign < 0 THEN '(' || balance::DECIMAL(18,2) || ')' ELSE balance::DECIMAL(18,2)::VARCHAR END
            AS balance_in_ic,
        CASE WHEN sign < 0 OR due_date IS NULL OR due_date > DATE '{as_of}' THEN 0
             ELSE datediff('day', due_date, DATE '{as_of}') END AS days_of_due,
        CASE WHEN sign < 0 OR amount IS NULL THEN ''
             WHEN due_date IS NULL OR due_date >= DATE '{as_of}' THEN 'No Due' ELSE 'Due' END AS due_status,
        strftime(due_date, '%b-%Y') AS due_month,
        coalesce(strftime(submitted_on, '%d-%b-%Y'), '-') AS submitted_on,
        coalesce(strftime(expected_on, '%d-%b-%Y'), '-') AS expected_on,
        po_no AS po_ref, credit_days::VARCHAR AS credit_period, contact_name, contact_email, contact_phone,
        project_code AS project_id, project_name
    FROM items""",
)
def _(t: Tables) -> DataFrame:
    return detail_sheet.detail_sheet(t, DEFAULT_AS_OF).drop("sort_date")


SHEET_ROWS = 400


@query(
    "sheet_manifest",
    f"""SELECT bdm_id, past // {SHEET_ROWS} AS part, count(*) AS rows,
        first(invoice_date ORDER BY invoice_date NULLS FIRST, doc_key)::DATE::VARCHAR AS first_date,
        first(doc_key ORDER BY invoice_date NULLS FIRST, doc_key) AS first_key,
        last(invoice_date ORDER BY invoice_date NULLS FIRST, doc_key)::DATE::VARCHAR AS last_date,
        last(doc_key ORDER BY invoice_date NULLS FIRST, doc_key) AS last_key
    FROM (SELECT *, rank() OVER (PARTITION BY bdm_id ORDER BY invoice_date NULLS FIRST, start) - 1 AS past
          FROM (SELECT *, CASE WHEN of_day > {SHEET_ROWS} THEN left(doc_key, 6) ELSE '' END AS start
                FROM (SELECT bdm_id, invoice_date, doc_key, count(*) OVER (PARTITION BY bdm_id, invoice_date) AS of_day FROM items)))
    GROUP BY 1, 2""",
)
def _(t: Tables) -> DataFrame:
    """The files of published sheets."""
    spark = t.invoices.sparkSession
    store = SheetStore(spark, shared_folder(spark))
    sheet, *more = (detail_sheet.detail_sheet(t, DEFAULT_AS_OF, only=source) for source in open_items.APART)
    store.publish(sheet, "run", "parquet", SHEET_ROWS, more)
    return store.manifest()


@query(
    "format_money",
    """SELECT id AS doc_id, currency, {money:balance_amount:currency} AS plus_text,
        {money:-balance_amount:currency} AS minus_text, {money:balance_amount / 1000000:currency} AS small_text
    FROM (SELECT i.id, i.balance_amount, cu.currency_code AS currency FROM invoices i
          LEFT JOIN currencies cu ON cu.id = i.id % 6)""",
)
def _(t: Tables) -> DataFrame:
    currencies = t.currencies.withColumnRenamed("id", "currency_id")
    rows = t.invoices.withColumn("currency_id", F.col("id") % 6).join(currencies, "currency_id", "left")
    balance, currency = F.col("balance_amount"), F.col("currency_code")
    return rows.select(
        F.col("id").alias("doc_id"),
        currency.alias("currency"),
        format_money(balance, currency).alias("plus_text"),
        format_money(-balance, currency).alias("minus_text"),
        format_money(balance / 1_000_000, currency).alias("small_text"),
    )


# --- summary ---------------------------------------------------------------------------------


@query(
    "ageing_bucket",
    """SELECT bdm_id, id AS doc_id, sales_order_id, due_date::VARCHAR AS due_date,
        {months:due_date} AS month_offset, {bucket:due_date} AS bucket
    FROM inv_star WHERE balance_amount > 0 AND status = 'a' AND bdm_id IS NOT NULL""",
)
def _(t: Tables) -> DataFrame:
    return exposure.invoice_buckets(t, DEFAULT_AS_OF)


@query("candidate_customers", "SELECT bdm_id, customer_code FROM candidates")
def _(t: Tables) -> DataFrame:
    return _summary(t).candidate_customers()


@query(
    "candidate_semi",
    """SELECT bdm_id, list_code AS customer_code, currency_code, sum(balance_amount)::DOUBLE AS amount
    FROM dir_star WHERE balance_amount > 0
      AND (bdm_id, list_code) IN (SELECT (bdm_id, customer_code) FROM candidates) GROUP BY 1, 2, 3""",
)
def _(t: Tables) -> DataFrame:
    return _summary(t).listed_direct()


HORIZON_SQL = f"SELECT bdm_id, {_day('last_due_date')}, months FROM horizon"


@query("ageing_horizon", HORIZON_SQL)
def _(t: Tables) -> DataFrame:
    return _summary(t).horizon()


@query("ageing_horizon_consolidated", HORIZON_SQL, horizon_sources="'INV', 'DIR', 'CON'")
def _(t: Tables) -> DataFrame:
    return _summary(t, LONG_HORIZON).horizon()


SUMMARY_COLUMNS = "bdm_id, customer_code, currency_code, bucket, month_offset"


def _summary_sql(source: str) -> str:
    return (
        f"SELECT {SUMMARY_COLUMNS}, sum(amount)::DOUBLE AS amount FROM summaries"
        f" WHERE source = '{source}' GROUP BY ALL"
    )


def _one_source(t: Tables, source: str) -> DataFrame:
    return _summary(t).by_source(source).drop("source")


@query("summary_inv", _summary_sql("INV"))
def _(t: Tables) -> DataFrame:
    return project_summary(t, DEFAULT_AS_OF)


@query("summary_con", _summary_sql("CON"))
def _(t: Tables) -> DataFrame:
    return _one_source(t, "CON")


@query("summary_dir", _summary_sql("DIR"))
def _(t: Tables) -> DataFrame:
    return _one_source(t, "DIR")


@query("summary_crn", _summary_sql("CRN"))
def _(t: Tables) -> DataFrame:
    return _one_source(t, "CRN")


MERGED_SQL = f"SELECT {SUMMARY_COLUMNS}, net_amount::DOUBLE AS net_amount FROM merged"
ONE_ORDER = (
    "s.sales_order_id = (SELECT min(x.id) FROM sales_orders x"
    " WHERE x.customer_id = s.project_id AND x.sales_person_id = s.bdm_id)"
)


@query("summary_merged", MERGED_SQL)
def _(t: Tables) -> DataFrame:
    return _summary(t).merged()


@query("summary_merged_credits_added", MERGED_SQL, added="true")
def _(t: Tables) -> DataFrame:
    return _summary(t, CREDITS_ADDED).merged()


@query("summary_merged_deduped", MERGED_SQL, inv_once=ONE_ORDER, con_once=ONE_ORDER)
def _(t: Tables) -> DataFrame:
    return _summary(t, DEDUPED).merged()


# Codes as people type them: in lower case, with an accent, with blanks behind.
TYPED_CODE = """case id % 4 when 0 then lower(customer_code) when 1 then replace(customer_code, 'C', 'Ç')
    when 2 then concat(customer_code, '  ') else customer_code end"""


def _collated(t: Tables) -> Tables:
    """The tables with typed codes on stand-alone invoices, and text keys compared by the database's collation."""
    typed = t.replace(direct_invoices=t.direct_invoices.withColumn("customer_code", F.expr(TYPED_CODE)))
    return Tables(lambda name: collated(getattr(typed, name), name))


@query(
    "collated_keys",
    f"""SELECT c.customer_code, any_value(c.customer_name) AS customer_name, min(d.typed) AS first_typed, count(*) AS documents,
        sum(d.balance_amount)::DOUBLE AS balance
    FROM (SELECT *, {TYPED_CODE} AS typed FROM direct_invoices) d
    JOIN customers c ON strip_accents(lower(rtrim(d.typed))) = strip_accents(lower(rtrim(c.customer_code))) GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    t = _collated(t)
    typed = F.min(F.collate("customer_code", "UTF8_BINARY")).alias("first_typed")
    sums = t.direct_invoices.groupBy("customer_code").agg(typed, F.count(F.lit(1)).alias("documents"), F.sum("balance_amount").alias("balance"))
    # Of the key's two spellings the customer's own is shown.
    return sums.withColumnRenamed("customer_code", "code").join(t.customers, F.col("code") == F.col("customer_code")).drop("code", "id", "division")


@query("summary_merged_collated", MERGED_SQL)
def _(t: Tables) -> DataFrame:
    """Typed codes find the same candidates as exact ones."""
    return _summary(_collated(t)).merged()


@query("summary_merged_month_end", MERGED_SQL, as_of=MONTH_END.isoformat())
def _(t: Tables) -> DataFrame:
    return _summary(t, as_of=MONTH_END).merged()


WIDE_MONTHS = 6
WIDE = [*dates.FIXED_BUCKETS, *[f"p{month}" for month in range(1, WIDE_MONTHS + 1)]]


@query(
    "summary_wide",
    f"""SELECT bdm_id, customer_code, currency_code,
        {', '.join(f"""(sum(net_amount) FILTER (bucket = '{name}'))::DOUBLE AS {name.replace('-', '')}""" for name in WIDE)}
    FROM merged GROUP BY 1, 2, 3""",
)
def _(t: Tables) -> DataFrame:
    wide = _summary(t).wide(WIDE_MONTHS)
    return wide.withColumnsRenamed({name: name.replace("-", "") for name in WIDE})


@query(
    "grand_total",
    """SELECT bdm_id, customer_code, currency_code, customer_label, grand_total::DOUBLE AS grand_total
    FROM labels_of_keys""",
)
def _(t: Tables) -> DataFrame:
    return _summary(t).grand_total()


@query("bucket_totals", f"SELECT bdm_id, source, bucket, month_offset, {_money('total')} FROM totals")
def _(t: Tables) -> DataFrame:
    return _summary(t).bucket_totals()


VISIBLE_SQL = """SELECT bdm_id, bucket, month_offset, total_text,
    CASE WHEN bucket = 'past' THEN 'Prior to ' || strftime(DATE '{as_of}' - INTERVAL 3 MONTH, '%b-%y')
         ELSE strftime(date_trunc('month', DATE '{as_of}') + to_months(month_offset::INTEGER), '%b-%y') END AS label,
    CASE WHEN bucket = 'current_not_due' OR month_offset > 0 THEN 'not_due' ELSE 'due' END AS section
    FROM visible"""


@query("visible_buckets", VISIBLE_SQL)
def _(t: Tables) -> DataFrame:
    return _summary(t).visible_buckets()


@query(
    "visible_spans",
    f"""SELECT bdm_id, count(*) FILTER (section = 'due') AS due_columns,
        count(*) FILTER (section = 'not_due') AS not_due_columns
    FROM ({VISIBLE_SQL}) GROUP BY bdm_id""",
)
def _(t: Tables) -> DataFrame:
    return _summary(t).visible_spans()


def _cell_sql(bucket: str) -> str:
    return f"""CASE WHEN list_contains(v.shown, '{bucket}')
        THEN {{money:coalesce(w."{bucket}", 0):k.currency_code}} END AS {bucket.replace('-', '')}"""


REPORT_SQL = f"""SELECT k.bdm_id, k.customer_code, k.currency_code, k.customer_label,
    {', '.join(_cell_sql(name) for name in dates.FIXED_BUCKETS)},
    coalesce(w.future_months, '') AS future_months,
    {{money:k.grand_total:k.currency_code}} AS grand_total
FROM labels_of_keys k
LEFT JOIN (SELECT bdm_id, list(bucket) AS shown FROM visible GROUP BY bdm_id) v ON v.bdm_id = k.bdm_id
LEFT JOIN (
    SELECT m.bdm_id, m.customer_code, m.currency_code,
        {', '.join(f'''sum(net_amount) FILTER (m.bucket = '{name}') AS "{name}"''' for name in dates.FIXED_BUCKETS)},
        string_agg(strftime(date_trunc('month', DATE '{{as_of}}') + to_months(m.month_offset::INTEGER), '%b-%y')
                   || '=' || ({{money:net_amount:m.currency_code}}), '; ' ORDER BY m.month_offset)
            FILTER (m.month_offset > 0 AND s.bucket IS NOT NULL
                    AND ({{money:net_amount:m.currency_code}}) <> '') AS future_months
    FROM merged m LEFT JOIN visible s ON s.bdm_id = m.bdm_id AND s.bucket = m.bucket
    GROUP BY 1, 2, 3) w
ON w.bdm_id = k.bdm_id AND w.customer_code = k.customer_code
   AND w.currency_code IS NOT DISTINCT FROM k.currency_code"""


@query("summary_report", REPORT_SQL)
def _(t: Tables) -> DataFrame:
    return _summary(t).report()


@query("summary_report_of_owners", REPORT_SQL + "\nWHERE k.bdm_id % 5 = 2")
def _(t: Tables) -> DataFrame:
    """The printed summary of some owners, over documents laid out by owner."""
    stored = store_by_owner(t, shared_folder(t.invoices.sparkSession), slots=16)
    return _summary(stored.of_owners(t.debtor_reports.filter("bdm_id % 5 = 2"))).report()


# --- people and configuration ----------------------------------------------------------------


@query("report_owners", "SELECT bdm_id, owner_name, email, employee_number, unit FROM owners")
def _(t: Tables) -> DataFrame:
    return people.report_owners(t)


FILE_NAME_SQL = (
    "'debtors_report_' || replace(owner_name, ' ', '_') || '_' || strftime(DATE '{as_of}', '%d-%b-%Y')"
)


@query("report_filename", f"SELECT bdm_id, {FILE_NAME_SQL} AS file_name FROM owners")
def _(t: Tables) -> DataFrame:
    return notify.report_files(t, DEFAULT_AS_OF)


@query("active_owners", "SELECT bdm_id FROM active")
def _(t: Tables) -> DataFrame:
    return people.active_owners(t)


@query("owner_cc", "SELECT bdm_id, cc_name, cc_email FROM copies")
def _(t: Tables) -> DataFrame:
    return people.owner_cc(t)


RECIPIENTS_SQL = """SELECT m.function_id, m.mail_to_type, e.work_email_address AS email, count(*) AS entries,
    any_value(g.greeting) AS greeting
FROM mail_configurations m JOIN employees e ON e.employee_number = m.employee_id
LEFT JOIN (SELECT m.function_id, max_by(e.first_name, m.id) AS greeting FROM mail_configurations m
           JOIN employees e ON e.employee_number = m.employee_id WHERE m.mail_to_type = 'to' GROUP BY 1) g
  ON g.function_id = m.function_id
WHERE m.mail_to_type IN ('to', 'cc', 'bcc') GROUP BY 1, 2, 3"""


@query("recipients_by_type", RECIPIENTS_SQL)
def _(t: Tables) -> DataFrame:
    return people.recipients_by_type(t)


MOST_LISTED = 3


@query(
    "recipient_lists",
    f"""SELECT function_id, greeting, (place - 1) // {MOST_LISTED} AS part,
        coalesce(string_agg(email, ',' ORDER BY email) FILTER (mail_to_type = 'to'), '') AS to_list,
        coalesce(string_agg(email, ',' ORDER BY email) FILTER (mail_to_type = 'cc'), '') AS cc_list,
        coalesce(string_agg(email, ',' ORDER BY email) FILTER (mail_to_type = 'bcc'), '') AS bcc_list
    FROM (SELECT *, row_number() OVER (PARTITION BY function_id, mail_to_type ORDER BY email NULLS LAST) AS place FROM ({RECIPIENTS_SQL}))
    GROUP BY 1, 2, 3""",
)
def _(t: Tables) -> DataFrame:
    rows = Stored(people.recipients_by_type(t), shared_folder(t.employees.sparkSession), "recipients").frame
    lists = people.recipient_lists(rows, MOST_LISTED)
    joined = {name: F.array_join(name, ",") for name in ("to_list", "cc_list", "bcc_list")}
    return lists.withColumns(joined)


@query(
    "config_lookup",
    """SELECT coalesce(f.name, s.name) AS name, f.function_id, s.schedule_id
    FROM (SELECT name, min(id) AS function_id FROM function_names WHERE type = 'Cron' GROUP BY 1) f
    FULL JOIN (SELECT name, min(id) AS schedule_id FROM schedules WHERE status = 1 GROUP BY 1) s
      ON s.name = f.name""",
)
def _(t: Tables) -> DataFrame:
    return people.config_lookup(t)


@query("config_map", "SELECT parent_key, configuration_key, configuration_value FROM config")
def _(t: Tables) -> DataFrame:
    return people.config_map(t)


@query("config_map_merged", "SELECT configuration_key, configuration_value FROM report_config")
def _(t: Tables) -> DataFrame:
    return people.config_map_merged(t)


@query(
    "notification_outbox",
    f"""SELECT o.bdm_id, o.email AS to_email,
        coalesce((SELECT string_agg(c.cc_name || ' <' || c.cc_email || '>', '; ' ORDER BY c.cc_name, c.cc_email)
                  FROM copies c WHERE c.bdm_id = o.bdm_id AND c.cc_email <> o.email), '') AS cc,
        coalesce((SELECT array_to_string(list_filter(list_transform(string_split(configuration_value, ','),
                         lambda x: trim(x)), lambda x: x <> ''), '; ')
                  FROM report_config WHERE configuration_key = 'debtors_bdm_cron_bcc'), '') AS bcc,
        (SELECT configuration_value FROM report_config WHERE configuration_key = 'ar_from') AS from_email,
        'Accounts Receivable' AS from_name,
        {FILE_NAME_SQL} AS subject, {FILE_NAME_SQL} || '.csv' AS attachment
    FROM owners o
    WHERE o.email IS NOT NULL AND o.bdm_id IN (SELECT bdm_id FROM active)
      AND o.bdm_id IN (SELECT bdm_id FROM summaries)""",
)
def _(t: Tables) -> DataFrame:
    outbox = notify.notification_outbox(t, _summary(t))
    shown = F.transform("cc", lambda copy: F.format_string("%s <%s>", copy["cc_name"], copy["cc_email"]))
    return outbox.withColumn("cc", F.array_join(shown, "; ")).withColumn("bcc", F.array_join("bcc", "; "))


@query(
    "outbox_handed_over",
    f"""SELECT o.bdm_id, o.email AS to_email, {FILE_NAME_SQL} || '.csv' AS attachment, 1 AS times FROM owners o
    WHERE o.email IS NOT NULL AND o.bdm_id IN (SELECT bdm_id FROM active) AND o.bdm_id IN (SELECT bdm_id FROM summaries)""",
)
def _(t: Tables) -> DataFrame:
    """What is handed over by a run that got half way and by two that came after it."""
    spark = t.employees.sparkSession
    folder = shared_folder(spark)
    outbox = Stored(notify.notification_outbox(t, _summary(t)), folder, "outbox").frame
    box = HandOff(spark, f"{folder}/handed")
    for rows in (outbox.filter("bdm_id % 2 = 0"), outbox, outbox):
        box.hand_over(rows)
    return box.handed_over().groupBy("bdm_id", "to_email", "attachment").agg(F.count(F.lit(1)).alias("times"))


# --- run log ---------------------------------------------------------------------------------

DUE_SQL = f"""SELECT name, max(id) AS schedule_id, max_by(hour, id) AS hour, max_by(minute, id) AS minute,
    epoch(DATE '{NOW.date()}')::BIGINT + max_by(hour, id) * 3600 + max_by(minute, id) * 60 + {NOW.second}
        AS planned_ts
FROM schedules
WHERE status = 1 AND dayofweek = dayofweek(DATE '{NOW.date()}')
  AND hour * 60 + minute >= {NOW.hour * 60 + NOW.minute}
GROUP BY name"""


@query("due_schedules", DUE_SQL)
def _(t: Tables) -> DataFrame:
    return runlog.due_schedules(t, NOW)


LATEST_SQL = """SELECT schedule_id, id, log, status, date_runned, date_cron FROM scheduler_logs {where}
QUALIFY row_number() OVER (PARTITION BY schedule_id ORDER BY date_runned DESC, id DESC) = 1"""


@query("latest_run", LATEST_SQL.replace("{where}", ""))
def _(t: Tables) -> DataFrame:
    return runlog.latest_run(t)


@query(
    "latest_run_filtered",
    LATEST_SQL.replace(
        "{where}",
        """WHERE to_timestamp(date_cron) AT TIME ZONE 'UTC' >= TIMESTAMP '2024-01-10'
        AND day(to_timestamp(date_cron) AT TIME ZONE 'UTC') = 20
        AND hour(to_timestamp(date_cron) AT TIME ZONE 'UTC') = 9""",
    ),
)
def _(t: Tables) -> DataFrame:
    return runlog.latest_run(t, since=dt.date(2024, 1, 10), parts={"d": 20, "H": 9})


SINCE = dt.date(2024, 1, 20)


@query("latest_run_since", LATEST_SQL.replace("{where}", f"WHERE to_timestamp(date_cron) AT TIME ZONE 'UTC' >= TIMESTAMP '{SINCE}'"))
def _(t: Tables) -> DataFrame:
    """Over a log with a folder for each day."""
    stored = runlog.store_by_day(t.scheduler_logs, f"{shared_folder(t.schedules.sparkSession)}/log")
    return runlog.latest_run(t.replace(scheduler_logs=stored), since=SINCE)


@query(
    "run_log_event",
    f"""SELECT schedule_id || '-' || planned_ts AS run_id, schedule_id,
        epoch(TIMESTAMP '{NOW}')::BIGINT AS event_ts, planned_ts, NULL::INTEGER AS status, '' AS message
    FROM ({DUE_SQL})""",
)
def _(t: Tables) -> DataFrame:
    return runlog.start_events(runlog.due_schedules(t, NOW), NOW)


RUN_SECONDS = 90


@query(
    "run_log_cycle",
    f"""SELECT schedule_id || '-' || planned_ts AS run_id, epoch(TIMESTAMP '{NOW}')::BIGINT AS started_ts,
        epoch(TIMESTAMP '{NOW}')::BIGINT + CASE WHEN schedule_id % 3 = 0 THEN 0 ELSE {RUN_SECONDS} END AS event_ts,
        schedule_id, planned_ts, CASE schedule_id % 3 WHEN 0 THEN NULL WHEN 1 THEN 1 ELSE 0 END AS status,
        CASE schedule_id % 3 WHEN 0 THEN '' WHEN 1 THEN 'sent' ELSE 'no connection' END AS message
    FROM ({DUE_SQL})""",
)
def _(t: Tables) -> DataFrame:
    """Runs that go on, have ended well, and have failed, all written by the run itself."""
    starts = runlog.start_events(runlog.due_schedules(t, NOW), NOW)
    end = NOW + dt.timedelta(seconds=RUN_SECONDS)
    done = runlog.end_events(starts.filter("schedule_id % 3 = 1"), end, runlog.DONE, "<b>sent</b>")
    failed = runlog.end_events(starts.filter("schedule_id % 3 = 2"), end, runlog.FAILED, "no connection<br")
    return runlog.run_state(starts.unionByName(done).unionByName(failed))


# The database's format letter and DuckDB's, for letters whose numbers or texts both know.
PART_LETTERS = {
    "Y": "%Y", "y": "%y", "m": "%m", "M": "%B", "b": "%b", "d": "%d", "j": "%j", "H": "%H", "I": "%I", "i": "%M",
    "s": "%S", "p": "%p", "T": "%H:%M:%S", "r": "%I:%M:%S %p", "w": "%w", "W": "%A", "a": "%a", "U": "%U", "v": "%V", "x": "%G",
}
TEXT_LETTERS = "MbpTrWa"
MOMENT = "to_timestamp(date_cron) AT TIME ZONE 'UTC'"


@query(
    "epoch_parts",
    f"""SELECT id, {', '.join(
        f"strftime({MOMENT}, '{duck}')" + ("" if part in TEXT_LETTERS else "::INTEGER") + f' AS part_{ord(part)}'
        for part, duck in PART_LETTERS.items())}
    FROM scheduler_logs""",
)
def _(t: Tables) -> DataFrame:
    parts = [dates.epoch_part(F.col("date_cron"), part).alias(f"part_{ord(part)}") for part in PART_LETTERS]
    return t.scheduler_logs.select("id", *parts)


def _run_state(spark: SparkSession, folder: str) -> DataFrame:
    return plain(runlog.run_state(star_run_events(prepare(spark), folder)))


REGISTRY["run_log_state"] = Query(
    _run_state,
    """WITH log AS (
        SELECT 'run-' || (event_id - event_id % 3) AS run_id, user_id AS schedule_id,
            floor(epoch(ts))::BIGINT AS event_ts, floor(epoch(date_trunc('hour', ts)))::BIGINT AS planned_ts,
            CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END AS status, event_type AS message
        FROM events)
    SELECT run_id, min(event_ts) OVER (PARTITION BY run_id) AS started_ts, event_ts, schedule_id, planned_ts,
        status, message
    FROM log QUALIFY row_number() OVER (PARTITION BY run_id 
        ORDER BY event_ts DESC, status DESC, message DESC, schedule_id DESC) = 1""",
)


def _run_log_compacted(spark: SparkSession, folder: str) -> DataFrame:
    """Two thirds of the events, a snapshot up to the middle of the month, then the rest, late events among them."""
    events = star_run_events(prepare(spark), folder)
    log = RunLog(spark, shared_folder(spark))
    late = F.pmod(F.col("event_ts"), F.lit(3)) == 0
    log.append(events.filter(~late))
    log.compact(dt.date(2024, 1, 15))
    log.append(events.filter(late))
    return plain(log.states())


REGISTRY["run_log_compacted"] = Query(_run_log_compacted, REGISTRY["run_log_state"].sql)


def _error_events(spark: SparkSession, folder: str) -> DataFrame:
    rows = notify.error_events(star_failures(prepare(spark), folder), NOW)
    return rows.withColumn("error_timestamp", F.date_format("error_timestamp", "yyyy-MM-dd HH:mm:ss"))


REGISTRY["error_events"] = Query(
    _error_events,
    rf"""SELECT '{NOW}' AS error_timestamp, '' AS error_code,
        CASE page_id % 3 WHEN 0 THEN 'Mail not sent' WHEN 1 THEN 'Mail not sent, PHP Mailer Exception'
             ELSE 'Mail not sent, Exception' END AS error_description,
        'Debtors' AS module_name, 'BDM cron' AS function_name, '0' AS emp_id,
        CASE WHEN page_id % 3 = 0 THEN '' ELSE
        regexp_replace(trim(CASE WHEN page_id % 5 = 0 THEN html || '<a href="x' ELSE html END, ' ' || chr(9) || chr(10) || chr(11) || chr(13)),
            '<!--(?s:.)*?(?:-->|\z)|<[^\s<>"''](?:[^<>"'']+|"[^"]*(?:"|\z)|''[^'']*(?:''|\z))*(?:>|\z)', '', 'g') END AS data,
        page_id AS failure_id
    FROM pages""",
)
assert AS_OF == DEFAULT_AS_OF.isoformat()
