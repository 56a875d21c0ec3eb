"""Column names and types of the receivables tables."""

from __future__ import annotations

# Types are ours; the systems this reads from keep them in their own DDL.
SCHEMAS = {
    "invoices": (
        "id long, project_id long, po_id long, invoice_code string, total_amount decimal(18,2),"
        " balance_amount decimal(18,2), invoice_date date, status string, deleted int,"
        " invoice_reference long, consolidated_id long, invoice_date_submission_customer date,"
        " expected_collection_date date"
    ),
    "invoice_consolidations": "id long",
    "invoice_consolidation_details": "invoice_consolidation_id long, invoice_id long",
    "direct_invoices": (
        "id long, customer_id long, customer_code string, po_no string, invoice_code string,"
        " total_amount decimal(18,2), balance_amount decimal(18,2), invoice_date date,"
        " credit_period int, invoicing_currency_id long, project_name string, rsh_id long,"
        " bdm_id long, pm_id long, sbu_id long, entity_id long, invoice_reference long,"
        " deleted int, invoice_date_submission_customer date, expected_collection_date date"
    ),
    "credit_notes": "id long, mode_no string, balance_amount decimal(18,2), date date, deleted int",
    "credit_references": (
        "credit_note_id long, customer_no long, currency string, project_id long, rsh_id long,"
        " bdm_id long, sbu string, entity string"
    ),
    "projects": (
        "id long, project_code string, project_name string, currency_id long, project_manager long"
    ),
    "project_so_masters": "project_id long, sales_order_id long",
    "sales_orders": (
        "id long, sales_order_code string, credit_period int, customer_id long,"
        " finance_contact_id long, rsh_id long, sales_person_id long, sbu long, currency_id long,"
        " legal_entity_id long"
    ),
    "project_purchase_orders": "id long, attachment_reference_no string, is_primary int",
    "po_so_masters": "po_id long, sales_order_id long",
    "customers": "id long, customer_code string, customer_name string, division string",
    "customer_contacts": (
        "id long, customer_id long, contact_person_name string, contact_person_email string,"
        " contact_person_mobile string"
    ),
    "currencies": "id long, currency_code string",
    "forex_conversions": "id long, from_currency_id long, date date, value decimal(18,6)",
    "employees": (
        "id long, employee_number string, first_name string, last_name string,"
        " work_email_address string, structure_name string, employment_status string"
    ),
    "general_approvers": (
        "id long, structure_id long, function_id long, employee_id string, status int"
    ),
    "company_structures": "id long, name string",
    "legal_entities": "id long, legal_entity string, legal_entity_code string",
    "debtor_reports": "bdm_id long",
    "function_names": "id long, type string, name string",
    "configuration_values": (
        "id long, parent_id long, configuration_key string, configuration_value string"
    ),
    "mail_configurations": (
        "id long, function_id long, structure_id long, employee_id string, mail_to_type string"
    ),
    "schedules": "id long, name string, status int, hour int, minute int, dayofweek int",
    "scheduler_logs": (
        "id long, schedule_id long, log string, status int, date_runned long, date_cron long"
    ),
    "error_log": (
        "error_timestamp timestamp, error_code string, error_description string,"
        " module_name string, function_name string, emp_id string, data string"
    ),
}

# Append-only log of a run: its latest row is the run's state.
RUN_EVENT_SCHEMA = (
    "run_id string, schedule_id long, event_ts long, planned_ts long, status int, message string"
)

# What tables without an id are split on when a database is read.
PARTITION_COLUMNS = {
    "credit_references": "credit_note_id",
    "invoice_consolidation_details": "invoice_id",
    "project_so_masters": "project_id",
    "po_so_masters": "po_id",
    "debtor_reports": "bdm_id",
}

# Text columns that take part in joins or grouping.
TEXT_KEYS = {
    "direct_invoices": ("customer_code", "invoice_code"),
    "credit_notes": ("mode_no",),
    "credit_references": ("currency", "entity"),
    "customers": ("customer_code",),
    "currencies": ("currency_code",),
    "employees": ("employee_number",),
    "general_approvers": ("employee_id",),
    "legal_entities": ("legal_entity",),
    "function_names": ("name",),
    "configuration_values": ("configuration_key",),
    "mail_configurations": ("employee_id",),
    "schedules": ("name",),
}


def columns_of(ddl: str) -> dict[str, str]:
    """Column names and types of a schema text, in order."""
    parts = ddl.replace(",2)", ";2)").replace(",6)", ";6)").split(",")
    return {name: kind.replace(";", ",") for name, kind in (part.split() for part in parts)}
