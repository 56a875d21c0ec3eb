"""One Spark session for all tests, and the hand-written tables most of them read."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import SparkSession

from duesight.session import prepare
from duesight.sources.schemas import SCHEMAS, columns_of
from duesight.sources.tables import Tables

AS_OF = dt.date(2001, 6, 15)


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()


def day(text: str | None) -> dt.date | None:
    return dt.date.fromisoformat(text) if text else None


def _cast(value, kind: str):
    if value is None:
        return None
    if kind.startswith("decimal"):
        return Decimal(str(value))
    return day(value) if kind == "date" else value


def table(spark, name: str, rows: list[dict]):
    """Rows given as dictionaries; columns left out are NULL."""
    fields = columns_of(SCHEMAS[name])
    assert all(set(row) <= set(fields) for row in rows), name
    data = [tuple(_cast(row.get(column), kind) for column, kind in fields.items()) for row in rows]
    return spark.createDataFrame(data, SCHEMAS[name])


def hand_tables(spark, **tables: list[dict]) -> Tables:
    """The given tables; all others are empty."""
    return Tables(lambda name: table(spark, name, tables.get(name, [])))


def records(df) -> list[dict]:
    return [row.asDict() for row in df.collect()]


def _order(number, owner, customer, credit, currency=1, **more) -> dict:
    return {
        "id": number,
        "sales_order_code": f"SO{number}",
        "sales_person_id": owner,
        "customer_id": customer,
        "credit_period": credit,
        "currency_id": currency,
        **more,
    }


def _invoice(number, project, date, balance, **more) -> dict:
    return {
        "id": number,
        "project_id": project,
        "invoice_code": f"IN{number}",
        "total_amount": balance,
        "balance_amount": balance,
        "invoice_date": date,
        "status": "a",
        "deleted": 0,
        **more,
    }


# Every case has its own owner, project or customer, so that one set of tables holds them all.
CASES = {
    "currencies": [
        {"id": 1, "currency_code": "INR"},
        {"id": 2, "currency_code": "USD"},
        {"id": 3, "currency_code": "EUR"},
    ],
    "forex_conversions": [
        {"id": 1, "from_currency_id": 1, "date": "2001-01-01", "value": 1},
        {"id": 2, "from_currency_id": 2, "date": "2001-01-01", "value": 60},
        {"id": 3, "from_currency_id": 2, "date": "2001-07-01", "value": 70},
    ],
    "employees": [
        {
            "id": number,
            "employee_number": f"E{number}",
            "first_name": first,
            "last_name": last,
            "work_email_address": f"{first.lower()}@example.com",
            "employment_status": status,
        }
        for number, first, last, status in [
            (1, "Ann", "Lee", "c"),
            (2, "Bob", "Gone", "r"),
            (3, "Cid", "Unknown", None),
            (4, "Dee", "Ray", "c"),
            (5, "Eve", "Idle", "c"),
            (6, "Fay", "May", "c"),
            (7, "Gil", None, "c"),
        ]
    ],
    "customers": [
        {"id": number, "customer_code": f"C{number}", "customer_name": f"Name {number}", "division": "north"}
        for number in range(1, 13)
    ],
    "projects": [
        {"id": project, "project_code": f"P{project}", "project_name": f"Job {project}", "currency_id": currency}
        for project, currency in [(10, 1), (20, 1), (30, 1), (40, 1), (50, 3), (60, 1), (70, 1), (80, 1), (90, 1), (95, 1)]
    ],
    "sales_orders": [
        _order(100, 1, 1, 10, finance_contact_id=1, sbu=1, legal_entity_id=1, rsh_id=4),
        _order(200, 4, 2, 10),
        _order(201, 4, 2, 40),
        _order(300, 4, 3, 10),
        _order(301, 6, 3, 10),
        _order(400, 6, 4, 10),
        _order(500, 7, 5, 10, currency=3),
        _order(600, 6, 6, 10),
        _order(700, 2, 7, 10),
        _order(800, 3, 8, 10),
        _order(900, 99, 9, 10),
        _order(950, 1, 10, None),
    ],
    "project_so_masters": [
        {"project_id": order // 10 if order != 950 else 95, "sales_order_id": order}
        for order in (100, 200, 300, 400, 500, 600, 700, 800, 900, 950)
    ]
    + [{"project_id": 20, "sales_order_id": 201}, {"project_id": 30, "sales_order_id": 301}],
    "project_purchase_orders": [
        {"id": 1, "attachment_reference_no": "X1", "is_primary": 0},
        {"id": 2, "attachment_reference_no": "P2", "is_primary": 1},
        {"id": 3, "attachment_reference_no": "P3", "is_primary": 1},
        {"id": 4, "attachment_reference_no": "OWN", "is_primary": 0},
        {"id": 5, "attachment_reference_no": "", "is_primary": 0},
    ],
    "po_so_masters": [{"po_id": number, "sales_order_id": 100} for number in (1, 2, 3)],
    "customer_contacts": [
        {"id": 1, "customer_id": 1, "contact_person_name": "Finance"},
        {"id": 2, "customer_id": 11, "contact_person_name": "Second"},
        {"id": 3, "customer_id": 11, "contact_person_name": "Third"},
    ],
    "general_approvers": [
        {"id": 1, "structure_id": 1, "function_id": 4, "employee_id": "E6", "status": 0},
        {"id": 2, "structure_id": 1, "function_id": 4, "employee_id": "E4", "status": 1},
        {"id": 3, "function_id": 50, "employee_id": "E1", "status": 1},
        {"id": 4, "function_id": 50, "employee_id": "E4", "status": 1},
        {"id": 5, "function_id": 50, "employee_id": "E6", "status": 0},
        {"id": 6, "function_id": 50, "employee_id": "E4", "status": 1},
    ],
    "function_names": [
        {"id": 50, "type": "Mail", "name": "DEBTORS_ccmail_empbase_e1"},
        {"id": 51, "type": "Mail", "name": "debtorsXccmail_empbase_E4"},
        {"id": 60, "type": "Cron", "name": "job"},
        {"id": 59, "type": "Cron", "name": "job"},
        {"id": 58, "type": "Web", "name": "job"},
    ],
    "company_structures": [{"id": 1, "name": "Unit"}],
    "legal_entities": [{"id": 1, "legal_entity": "Entity", "legal_entity_code": "EN"}],
    "debtor_reports": [{"bdm_id": owner} for owner in (1, 1, 2, 3, 4, 5, 6, 7, 99)],
    "invoices": [
        _invoice(1001, 10, "2001-06-05", 100),
        _invoice(1002, 10, "2001-06-04", 200, po_id=4, invoice_date_submission_customer="2001-06-06"),
        _invoice(1003, 10, "2001-05-21", 400, po_id=5, invoice_reference=0),
        _invoice(1004, 10, "2001-03-21", 800),
        _invoice(1005, 10, "2001-02-18", 1600, total_amount=None),
        # revised by the next one
        _invoice(1010, 10, "2001-07-01", 10),
        _invoice(1011, 10, "2001-07-01", 20, invoice_reference=1010),
        # not approved, deleted, settled, overpaid
        _invoice(1012, 10, "2001-06-05", 7, status="d"),
        _invoice(1013, 10, "2001-06-05", 9, deleted=1),
        _invoice(1014, 10, "2001-06-05", 0),
        _invoice(1015, 95, "2001-06-05", -5),
        # several sales orders: of one owner, of two owners
        _invoice(1020, 20, "2001-06-05", 50),
        _invoice(1030, 30, "2001-06-05", 70),
        # a consolidation of two invoices, and one that consolidates itself
        _invoice(2000, None, "2001-06-01", 300, consolidated_id=1),
        _invoice(2001, 40, "2001-05-01", 100),
        _invoice(2002, 40, "2001-06-10", 200),
        _invoice(2100, 60, "2001-06-01", 30, consolidated_id=2),
        # currency without a rate
        _invoice(1050, 50, "2001-05-21", 123456.5),
        # owners who left, of unknown status, and unknown
        _invoice(1070, 70, "2001-06-05", 1),
        _invoice(1080, 80, "2001-06-05", 1),
        _invoice(1090, 90, "2001-06-05", 1),
    ],
    "invoice_consolidations": [{"id": 1}, {"id": 2}],
    "invoice_consolidation_details": [
        {"invoice_consolidation_id": 1, "invoice_id": 2001},
        {"invoice_consolidation_id": 1, "invoice_id": 2002},
        {"invoice_consolidation_id": 2, "invoice_id": 2100},
    ],
    "direct_invoices": [
        {
            "id": number,
            "bdm_id": 4,
            "customer_id": customer,
            "customer_code": code,
            "invoice_code": text,
            "total_amount": amount,
            "balance_amount": amount,
            "invoice_date": "2001-06-01",
            "credit_period": 5,
            "invoicing_currency_id": currency,
            "deleted": deleted,
            "invoice_reference": revises,
        }
        for number, customer, code, text, amount, currency, deleted, revises in [
            (1, 11, "C11", "D1", 11, 2, 0, None),
            (2, 11, "C11", "D1", 12, 2, 0, None),  # same code: shown once
            (3, 12, "CX", "D3", 13, 2, 0, None),  # own code differs from its customer's
            (4, 11, "C11", "D4", 14, 2, 1, None),  # deleted, but in the summary
            (5, 11, "C11", "D5", 15, 2, 0, None),  # revised by the next one
            (6, 11, "C11", "D6", 16, 2, 0, 5),
        ]
    ],
    "credit_notes": [
        {"id": 1, "mode_no": "N1", "balance_amount": 5, "date": "2001-07-20", "deleted": 0},
        {"id": 2, "mode_no": "N2", "balance_amount": 6, "date": "2002-03-01", "deleted": 0},
        {"id": 3, "mode_no": "N3", "balance_amount": 8, "date": "2001-06-01", "deleted": 1},
        {"id": 4, "mode_no": "N4", "balance_amount": 2.5, "date": "2001-05-02", "deleted": 0},
    ],
    "credit_references": [
        {"credit_note_id": number, "customer_no": 1, "currency": "INR", "bdm_id": 1, "entity": "Entity", "sbu": "U"}
        for number in (1, 2, 3, 4)
    ],
    "configuration_values": [
        {"id": 1, "configuration_key": "mail_details"},
        {"id": 2, "configuration_key": "ar_mail_config"},
        {"id": 3, "parent_id": 1, "configuration_key": "host", "configuration_value": "server"},
        {"id": 4, "parent_id": 1, "configuration_key": "user", "configuration_value": "secret"},
        {"id": 5, "parent_id": 2, "configuration_key": "host", "configuration_value": "other"},
        {"id": 6, "parent_id": 2, "configuration_key": "ar_from", "configuration_value": "old"},
        {"id": 7, "parent_id": 2, "configuration_key": "ar_from", "configuration_value": "new"},
        {
            "id": 8,
            "parent_id": 2,
            "configuration_key": "debtors_bdm_cron_bcc",
            "configuration_value": "x@example.com, y@example.com,,",
        },
    ],
    "mail_configurations": [
        {"id": 1, "function_id": 9, "structure_id": 1, "employee_id": "E1", "mail_to_type": "to"},
        {"id": 2, "function_id": 9, "structure_id": 1, "employee_id": "E1", "mail_to_type": "to"},
        {"id": 3, "function_id": 9, "structure_id": 2, "employee_id": "E4", "mail_to_type": "to"},
        {"id": 4, "function_id": 9, "structure_id": 1, "employee_id": "E6", "mail_to_type": "cc"},
        {"id": 5, "function_id": 9, "structure_id": 1, "employee_id": "E6", "mail_to_type": "x"},
    ],
    "schedules": [
        {"id": 1, "name": "job", "status": 1, "hour": 10, "minute": 0, "dayofweek": 5},
        {"id": 2, "name": "job", "status": 1, "hour": 9, "minute": 30, "dayofweek": 5},
        {"id": 3, "name": "job", "status": 1, "hour": 9, "minute": 29, "dayofweek": 5},
        {"id": 4, "name": "job", "status": 0, "hour": 12, "minute": 0, "dayofweek": 5},
        {"id": 5, "name": "job", "status": 1, "hour": 12, "minute": 0, "dayofweek": 6},
    ],
}


@pytest.fixture(scope="session")
def cases(spark):
    return hand_tables(spark, **CASES)
