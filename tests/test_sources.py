"""Reading from files and databases, writing sheets and logs."""

from __future__ import annotations

import csv
import datetime as dt
from pathlib import Path
from types import SimpleNamespace

import pytest

from duesight.plans import runlog
from duesight.plans.detail_sheet import SHEET_HEADINGS, detail_sheet
from duesight.plans.summary import AgeingSummary
from duesight.session import Stored
from duesight.sources import sinks, tables
from duesight.sources.schemas import RUN_EVENT_SCHEMA, SCHEMAS, columns_of
from tests.conftest import AS_OF, CASES, records


def test_csv_tables_lose_zero_dates_and_keep_types(spark, tmp_path):
    folder = tmp_path / "invoices"
    folder.mkdir()
    columns = list(columns_of(SCHEMAS["invoices"]))
    row = dict.fromkeys(columns, "")
    row |= {"id": "7", "balance_amount": "12.50", "invoice_date": "2001-06-01", "expected_collection_date": "0000-00-00"}
    with open(folder / "part.csv", "w", newline="") as file:
        writer = csv.DictWriter(file, columns)
        writer.writeheader()
        writer.writerow(row)
    invoice = tables.file_tables(spark, str(tmp_path), "csv").invoices
    assert invoice.schema == spark.createDataFrame([], SCHEMAS["invoices"]).schema
    values = invoice.first()
    assert (values["id"], str(values["balance_amount"])) == (7, "12.50")
    assert (values["invoice_date"], values["expected_collection_date"]) == (dt.date(2001, 6, 1), None)
    assert values["invoice_reference"] is None


def test_parquet_tables_push_filters_and_columns(spark, cases, tmp_path):
    cases.invoices.write.parquet(str(tmp_path / "invoices"))
    invoices = tables.file_tables(spark, str(tmp_path)).invoices
    plan = invoices.filter("balance_amount > 0").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(balance_amount,0.00)" in plan
    assert "ReadSchema: struct<id:bigint,balance_amount:decimal(18,2)>" in plan


def test_normalised_keys(spark, tmp_path):
    rows = [(1, "Ab ", "Name "), (2, "AB", "name")]
    spark.createDataFrame(rows, "id long, customer_code string, customer_name string").selectExpr(
        "*", "'' as division"
    ).write.parquet(str(tmp_path / "customers"))
    customers = tables.file_tables(spark, str(tmp_path), normalise_keys=True).customers
    assert {(row["customer_code"], row["customer_name"]) for row in records(customers)} == {("ab", "Name "), ("ab", "name")}


def test_unknown_table(cases):
    with pytest.raises(AttributeError):
        cases.nothing  # noqa: B018


def test_jdbc_reader_splits_large_tables(spark):
    class Reader:
        def __init__(self):
            self.seen = {}

        def format(self, name):
            self.seen["format"] = name
            return self

        def options(self, **values):
            self.seen |= values
            return self

        def option(self, name, value):
            return self.options(**{name: value})

        def load(self):
            return spark.createDataFrame([], SCHEMAS["direct_invoices"])

    reader = Reader()
    source = tables.jdbc_tables(
        SimpleNamespace(read=reader),
        {"url": "jdbc:any"},
        key_ranges={"direct_invoices": (1, 1000)},
        partitions=8,
        renamed={"direct_invoices": "other_invoices"},
    )
    assert source.direct_invoices.count() == 0
    assert reader.seen == {
        "format": "jdbc",
        "url": "jdbc:any",
        "dbtable": "other_invoices",
        "partitionColumn": "id",
        "lowerBound": 1,
        "upperBound": 1000,
        "numPartitions": 8,
    }


def test_jdbc_tables_without_ranges_are_split_by_remainder(spark, cases):
    """Every row of a table meets exactly one of the conditions its reads are made with."""
    seen = {}

    def jdbc(url, table, predicates, properties):
        seen.update(url=url, table=table, predicates=predicates, properties=properties)
        return cases.invoices

    source = tables.jdbc_tables(SimpleNamespace(read=SimpleNamespace(jdbc=jdbc)), {"url": "jdbc:any", "user": "u"}, {}, partitions=4)
    assert source.invoices.count() == cases.invoices.count()
    assert (seen["url"], seen["table"], seen["properties"]) == ("jdbc:any", "invoices", {"user": "u"})
    numbers = spark.createDataFrame([(i,) for i in (-5, -1, 0, 3, 4, 10**12, None)], "id long")
    reads = [numbers.filter(condition.replace("MOD(", "mod(")).collect() for condition in seen["predicates"]]
    assert len(reads) == 4 and sorted((r.id for read in reads for r in read), key=str) == sorted((-5, -1, 0, 3, 4, 10**12, None), key=str)
    assert tables.hash_predicates("id", 1) == ["MOD(ABS(id), 1) = 0 OR id IS NULL"]


def test_collated_tables(spark, tmp_path):
    """Codes that differ in case, accents and trailing blanks are one key; the text stays as it was written."""
    rows = [(1, "Ab ", "x"), (2, "ÀB", "y"), (3, "a", "z")]
    spark.createDataFrame(rows, "id long, customer_code string, customer_name string").selectExpr("*", "'' as division").write.parquet(str(tmp_path / "customers"))
    customers = tables.file_tables(spark, str(tmp_path), collation=tables.KEY_COLLATION).customers
    assert {r.customer_code for r in customers.collect()} == {"Ab ", "ÀB", "a"}
    assert sorted(r["count"] for r in customers.groupBy("customer_code").count().collect()) == [1, 2]


@pytest.mark.parametrize("name", ["credit_references", "invoice_consolidation_details", "project_so_masters", "po_so_masters", "debtor_reports"])
def test_tables_without_an_id_are_read_in_parallel(spark, name):
    seen = {}

    class Reader:
        def format(self, _):
            return self

        def options(self, **values):
            seen.update(values)
            return self

        def option(self, *_):
            return self

        def load(self):
            return spark.createDataFrame([], SCHEMAS[name])

    source = tables.jdbc_tables(SimpleNamespace(read=Reader()), {}, key_ranges={name: (1, 9)}, partitions=4)
    assert getattr(source, name).count() == 0
    assert seen["partitionColumn"] in columns_of(SCHEMAS[name]) and seen["numPartitions"] == 4


def test_detail_sheets(cases, tmp_path):
    folder = tmp_path / "sheets"
    sinks.write_detail_sheets(detail_sheet(cases, AS_OF), str(folder))
    assert {path.name for path in folder.glob("bdm_id=*")} == {f"bdm_id={owner}" for owner in (1, 2, 3, 4, 6, 7)}
    lines = []
    for path in sorted((folder / "bdm_id=1").glob("*.csv")):
        with open(path, newline="") as file:
            rows = list(csv.reader(file))
        assert rows[0] == list(SHEET_HEADINGS.values())
        lines += rows[1:]
    assert [line[1] for line in lines] == ["IN1005", "IN1004", "N4", "IN1003", "IN1002", "IN1001", "N1", "N2"]


def test_summary_is_ordered(cases, tmp_path):
    folder = tmp_path / "summary"
    sinks.write_summary(AgeingSummary(cases, AS_OF).report(), str(folder))
    keys = []
    for path in sorted(folder.glob("*.csv")):
        with open(path, newline="") as file:
            keys += [(int(row["bdm_id"]), row["customer_code"]) for row in csv.DictReader(file)]
    assert keys == sorted(keys) and (1, "C1") in keys


def test_log_is_only_appended_to(spark, tmp_path):
    folder = str(tmp_path / "log")
    first = spark.createDataFrame([("r1", 1, 10, 10, None, "")], RUN_EVENT_SCHEMA)
    sinks.append_rows(first, folder)
    sinks.append_rows(runlog.end_events(first, dt.datetime(2001, 6, 15), runlog.DONE), folder)
    log = spark.read.parquet(folder)
    assert log.count() == 2
    assert runlog.run_state(log).first()["status"] == 1


def test_outbox_is_one_json_line_per_owner(spark, tmp_path):
    outbox = spark.createDataFrame([(1, "a@example.com", ["b"])], "bdm_id long, to_email string, bcc array<string>")
    sinks.write_outbox(outbox, str(tmp_path / "outbox"))
    text = "".join(path.read_text() for path in Path(tmp_path / "outbox").glob("*.json"))
    assert text.strip() == '{"bdm_id":1,"to_email":"a@example.com","bcc":["b"]}'


def test_stored_table_is_read_back_by_column(spark, tmp_path):
    stored = Stored(spark.range(10).selectExpr("id % 3 as k").groupBy("k").count(), str(tmp_path), "counts")
    assert {tuple(row) for row in stored.frame.collect()} == {(0, 4), (1, 3), (2, 3)}
    plan = stored.frame.select("k")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<k:bigint>" in plan and "Aggregate" not in plan
    stored.delete()
    assert not list(tmp_path.iterdir())


def test_summary_is_stored_only_where_a_folder_is_named(cases, tmp_path):
    want = sorted(map(tuple, AgeingSummary(cases, AS_OF).merged().collect()), key=str)
    with AgeingSummary(cases, AS_OF, folder=str(tmp_path)) as summary:
        assert not list(tmp_path.iterdir())
        assert sorted(map(tuple, summary.merged().collect()), key=str) == want
        summary.report().collect()
        assert len(list(tmp_path.iterdir())) == 1
    assert not list(tmp_path.iterdir())


def test_one_source_reads_no_other(cases):
    plan = AgeingSummary(cases, AS_OF).by_source("CON")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "mode_no" not in text


@pytest.mark.parametrize(
    ("table", "column", "value"),
    [
        ("forex_conversions", "value", "1234567890123.5"),
        ("forex_conversions", "value", "0.00000049"),
        ("forex_conversions", "value", "abc"),
        ("invoices", "balance_amount", "12345678901234567.00"),
        ("invoices", "invoice_date", "soon"),
        ("invoices", "project_id", "7x"),
    ],
)
def test_values_a_type_cannot_hold_stop_the_read(spark, table, column, value):
    names = list(columns_of(SCHEMAS[table]))
    given = spark.createDataFrame([{**dict.fromkeys(names, ""), column: value}], ", ".join(f"{n} string" for n in names))
    with pytest.raises(Exception, match=f"{column} can't hold"):
        tables.conform(given, table).collect()


def test_a_long_rate_is_held(spark):
    given = spark.createDataFrame([("1", "2", "2001-01-01", "123456789.5")], "id string, from_currency_id string, date string, value string")
    assert str(tables.conform(given, "forex_conversions").first().value) == "123456789.500000"


def test_cases_cover_every_table():
    assert set(SCHEMAS) - set(CASES) == {"scheduler_logs", "error_log"}
