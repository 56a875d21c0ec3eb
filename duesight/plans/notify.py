"""Who gets which report: one outbox row per active owner with something to report."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duesight.functions.text import report_file_name, strip_tags
from duesight.plans.people import active_owners, config_map_merged, owner_cc, report_owners
from duesight.plans.summary import AgeingSummary
from duesight.settings import BCC_CONFIG_KEY, SENDER_CONFIG_KEY
from duesight.sources.tables import Tables

# What a failed hand-over is logged as, and what a trim removes.
FAILURES = {
    "refused": "Mail not sent",
    "mailer": "Mail not sent, PHP Mailer Exception",
    "other": "Mail not sent, Exception",
}
MAIL_MODULE = "Debtors"
MAIL_FUNCTION = "BDM cron"
NO_EMPLOYEE = "0"
SENDER_NAME = "Accounts Receivable"
TRIMMED = " \t\n\r\0\x0b"


def report_files(t: Tables, as_of: dt.date) -> DataFrame:
    return report_owners(t).select(
        "bdm_id", report_file_name(F.col("owner_name"), as_of).alias("file_name")
    )


def address_list(text: Column) -> Column:
    """Addresses of a comma-separated setting, without blanks and empty entries."""
    parts = F.transform(F.split(text, ","), lambda address: F.trim(address))
    return F.filter(parts, lambda address: address != "")


def mail_settings(t: Tables) -> DataFrame:
    """One row, also without settings: the addresses every report goes to unseen, and the sender's."""
    value = lambda key: F.max(F.when(F.col("configuration_key") == key, F.col("configuration_value")))
    return config_map_merged(t).agg(
        F.coalesce(address_list(value(BCC_CONFIG_KEY)), F.array().cast("array<string>")).alias("bcc"),
        value(SENDER_CONFIG_KEY).alias("from_email"),
    )


def notification_outbox(t: Tables, summary: AgeingSummary, extension: str = "csv") -> DataFrame:
    """Sender, recipient, copies, subject and attachment. An owner's own address is no copy."""
    known = report_owners(t).filter(F.col("email").isNotNull())
    owners = known.join(active_owners(t), "bdm_id", "left_semi").join(summary.reported_owners(), "bdm_id", "left_semi")
    copies = (
        owner_cc(t)
        .join(known.select("bdm_id", "email"), "bdm_id")
        .filter(F.col("cc_email") != F.col("email"))
        .groupBy("bdm_id")
        .agg(F.array_sort(F.collect_list(F.struct("cc_name", "cc_email"))).alias("cc"))
    )
    no_copies = F.array().cast("array<struct<cc_name: string, cc_email: string>>")
    subject = report_file_name(F.col("owner_name"), summary.as_of)
    settings = mail_settings(t)
    return owners.join(copies, "bdm_id", "left").select(
        "bdm_id",
        settings.select("from_email").scalar().alias("from_email"),
        F.lit(SENDER_NAME).alias("from_name"),
        F.col("email").alias("to_email"),
        F.coalesce("cc", no_copies).alias("cc"),
        settings.select("bcc").scalar().alias("bcc"),
        subject.alias("subject"),
        F.concat(subject, F.lit(f".{extension}")).alias("attachment"),
    )


def error_events(failures: DataFrame, now: dt.datetime) -> DataFrame:
    """Rows for the error log out of failures: their ``cause``, a key of ``FAILURES``, and ``message``.

    A refused mail leaves no message. An unknown cause counts as any other exception.
    """
    cause = F.col("cause") if "cause" in failures.columns else F.lit("other")
    description = F.lit(FAILURES["other"])
    for name in ("refused", "mailer"):
        description = F.when(cause == name, FAILURES[name]).otherwise(description)
    message = F.when(cause.eqNullSafe("refused"), F.lit("")).otherwise(strip_tags(F.btrim("message", F.lit(TRIMMED))))
    return failures.select(
        F.lit(now).alias("error_timestamp"),
        F.lit("").alias("error_code"),
        description.alias("error_description"),
        F.lit(MAIL_MODULE).alias("module_name"),
        F.lit(MAIL_FUNCTION).alias("function_name"),
        F.lit(NO_EMPLOYEE).alias("emp_id"),
        message.alias("data"),
        *[name for name in failures.columns if name not in ("message", "cause")],
    )
