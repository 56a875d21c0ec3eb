"""Fixed values of the report and the few knobs a caller may turn."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# Source tags of an open item.
INV = "INV"  # invoice that belongs to a project
CON = "CON"  # consolidated parent invoice
DIR = "DIR"  # stand-alone invoice
CRN = "CRN"  # credit note without a reference invoice

# Codes that stored rows carry.
APPROVED_STATUS = "a"
DEPARTED_STATUSES = ("r", "q", "b", "o", "t")
BUSINESS_HEAD_FUNCTION = 4
CC_FUNCTION_PREFIX = "debtors_ccmail_empbase_"
CRON_TYPE = "Cron"
RECIPIENT_TYPES = ("to", "cc", "bcc")
SERVER_CONFIG_PARENT = "mail_details"
SERVER_CONFIG_KEYS = ("host", "port")
REPORT_CONFIG_PARENT = "ar_mail_config"
SENDER_CONFIG_KEY = "ar_from"
BCC_CONFIG_KEY = "debtors_bdm_cron_bcc"
DOC_KEY_PREFIX = {INV: "", CON: "", DIR: "NON_", CRN: "Cr_"}
INDIAN_GROUPING_CURRENCY = "INR"
FILE_PREFIX = "debtors_report"
BLANK = " "

# Money of a single document, sums of money, and rates. A document times a rate is
# exact; a sum times a rate has six decimal places, four more than any result shows.
MONEY = "decimal(18,2)"
MONEY_SUM = "decimal(23,2)"
RATE = "decimal(18,6)"

DEFAULT_AS_OF = dt.date(2001, 6, 15)


@dataclass(frozen=True)
class SummaryOptions:
    """Departures from the summary's usual rules.

    ``dedupe_orders``: an invoice counts once per owner, not once per sales order.
    ``corrected_rates``: if the newest rate lies in the future, use the last known one.
    ``future_credits_added``: credits of future months are added to the cell, not subtracted.
    ``consolidated_horizon``: consolidated invoices also extend the future months.
    """

    dedupe_orders: bool = False
    corrected_rates: bool = False
    future_credits_added: bool = False
    consolidated_horizon: bool = False


USUAL = SummaryOptions()
