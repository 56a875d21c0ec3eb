"""Money text, names, file names and tag stripping."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from duesight.settings import FILE_PREFIX, INDIAN_GROUPING_CURRENCY

# Where a comma goes, and what counts as a tag. A comment, tag or quoted
# value that is never closed runs to the end of the text. Quantifiers are possessive, so
# every character is passed once and a long tag takes no stack.
_GROUP_BY_THREE = r"(?<=\d)(?=(\d{3})+$)"
_GROUP_INDIAN = r"(?<=\d)(?=(\d{2})*\d{3}$)"
_TAG = r"""(?s)<!--(?:.*?-->|.*+)|<[^\s<>"'](?:[^<>"']++|"[^"]*+(?:"|\z)|'[^']*+(?:'|\z))*+(?:>|\z)"""


def format_money(value: Column, currency: Column | None = None) -> Column:
    """Whole-unit money text: ``1,234``; ``(1,234)`` when negative; empty for zero or NULL.

    A negative value that rounds to zero still shows ``(0)``. Rupee amounts are
    grouped 3-2-2.
    """
    digits = F.round(F.abs(value), 0).cast("decimal(38,0)").cast("string")
    plain = F.regexp_replace(digits, _GROUP_BY_THREE, ",")
    if currency is not None:
        indian = F.regexp_replace(digits, _GROUP_INDIAN, ",")
        is_rupee = F.coalesce(currency == INDIAN_GROUPING_CURRENCY, F.lit(False))
        plain = F.when(is_rupee, indian).otherwise(plain)
    return (
        F.when(value.isNull(), "")
        .when(value < 0, F.concat(F.lit("("), plain, F.lit(")")))
        .when(digits == "0", "")
        .otherwise(plain)
    )


def credit_text(value: Column) -> Column:
    return F.concat(F.lit("("), value.cast("string"), F.lit(")"))


def person_name(first: Column, last: Column) -> Column:
    """Full name; NULL if either part is missing."""
    return F.concat(first, F.lit(" "), last)


def code_and_name(code: Column, name: Column) -> Column:
    return F.concat(code, F.lit(" - "), name)


def strip_tags(text: Column) -> Column:
    return F.regexp_replace(text, _TAG, "")


def report_file_name(owner_name: Column, as_of: dt.date, prefix: str = FILE_PREFIX) -> Column:
    return F.concat_ws(
        "_",
        F.lit(prefix),
        F.translate(owner_name, " ", "_"),
        F.date_format(F.lit(as_of), "dd-MMM-yyyy"),
    )
