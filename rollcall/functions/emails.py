"""E-mail addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall.functions.texts import strip
from rollcall.schema import no_strings

# Fixed value: shape of an address.
EMAIL = r"[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}"


def emails_in_text(text: Column) -> Column:
    """Distinct addresses of a text, sorted. Texts without ``@`` skip the pattern."""
    found = F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(EMAIL), F.lit(0))))
    return F.coalesce(F.when(F.contains(text, F.lit("@")), found), no_strings())


def is_valid_email(value: Column) -> Column:
    return F.coalesce(strip(value).rlike(f"^{EMAIL}$"), F.lit(False))


def valid_emails(values: Column) -> Column:
    """Valid addresses of a list in first-seen order, each once, otherwise unchanged."""
    return F.coalesce(F.array_distinct(F.filter(values, is_valid_email)), no_strings())
