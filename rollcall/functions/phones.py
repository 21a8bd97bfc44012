"""Phone numbers. The country code and trunk prefix are parameters; the defaults are +7 and 8."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall.functions.binding import let
from rollcall.schema import no_strings


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _from_digits(number: Column, country: str, trunk: str, national: int) -> Column:
    full = national + len(country)
    whole = (
        F.when(
            (F.length(number) == national + len(trunk)) & F.startswith(number, F.lit(trunk)),
            F.concat(F.lit(country), F.substring(number, len(trunk) + 1, national)),
        )
        .when(F.length(number) == national, F.concat(F.lit(country), number))
        .otherwise(number)
        if trunk
        else F.when(F.length(number) == national, F.concat(F.lit(country), number)).otherwise(number)
    )
    return F.when(F.length(whole) == full, F.when(F.startswith(whole, F.lit(country)), whole))


def normalize_phone(value: Column, country: str = "7", trunk: str = "8", national: int = 10) -> Column:
    """Country code and national number without ``+``, or null."""
    return let(digits(value), lambda number: _from_digits(number, country, trunk, national))


def normalize_phones(values: Column, country: str = "7", trunk: str = "8", national: int = 10) -> Column:
    """Valid numbers of a list in first-seen order, each once."""
    numbers = F.transform(F.transform(values, digits), lambda n: _from_digits(n, country, trunk, national))
    return F.coalesce(F.array_distinct(F.filter(numbers, lambda n: n.isNotNull())), no_strings())


def is_valid_phone(value: Column, country: str = "7", national: int = 10) -> Column:
    return F.coalesce(digits(value).rlike(f"^{country}[0-9]{{{national}}}$"), F.lit(False))


def phone_pattern(country: str = "7", plus_optional: bool = True) -> str:
    """Numbers in running text: country code, then 3-3-2-2 digits with loose separators."""
    gap = r"[\s\-()]*"
    plus = r"\+?" if plus_optional else r"\+"
    return rf"{plus}{country}{gap}\d{{3}}{gap}\d{{3}}{gap}\d{{2}}{gap}\d{{2}}"


def phones_in_text(text: Column, country: str = "7", plus_optional: bool = True) -> Column:
    found = F.regexp_extract_all(text, F.lit(phone_pattern(country, plus_optional)), F.lit(0))
    return F.coalesce(found, no_strings())


def strip_separators(value: Column) -> Column:
    """Removes ``-``, spaces and parentheses only; a leading ``+`` stays."""
    return F.translate(value, "- ()", "")
