"""Names, slugs, addresses and other plain text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall.functions.binding import let

# Whitespace that is cut from both ends of a value.
BLANKS = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Transliteration of Cyrillic letters.
ONE_TO_ONE = ("абвгдезийклмнопрстуфыэъь", "abvgdeziyklmnoprstufye")
ONE_TO_MANY = {
    "ё": "yo",
    "ж": "zh",
    "х": "kh",
    "ц": "ts",
    "ч": "ch",
    "ш": "sh",
    "щ": "shch",
    "ю": "yu",
    "я": "ya",
}

# Fixed value: the street behind a street word, up to a comma or a digit.
STREET = r"(?:ул\.?|улица|пр-т\.?|проспект|пер\.?|переулок)\s*(.+?)[,\d]"
CITY_MARKS = ("г. ", "город ")


def strip(value: Column) -> Column:
    return F.btrim(value, F.lit(BLANKS))


def blank_to_null(value: Column) -> Column:
    return F.nullif(strip(value), F.lit(""))


def transliterate(value: Column) -> Column:
    """Lower-cased text with Cyrillic letters written in Latin; other characters stay."""
    single = F.translate(F.lower(value), *ONE_TO_ONE)
    return reduce(lambda text, pair: F.replace(text, F.lit(pair[0]), F.lit(pair[1])), ONE_TO_MANY.items(), single)


def slugify(value: Column) -> Column:
    latin = transliterate(strip(F.coalesce(value, F.lit(""))))
    kept = F.regexp_replace(latin, r"[^a-z0-9\s-]", "")
    return F.btrim(F.regexp_replace(kept, r"\s+", "-"), F.lit("-"))


def directory_subdomain(city: Column) -> Column:
    """Slug of a city, with a final ``iy`` written ``ij``."""
    return F.regexp_replace(slugify(city), "iy$", "ij")


def street_of(address: Column) -> Column:
    """Lower-cased street name; without a street word, the text before the first comma."""

    def behind_city(lowered: Column) -> Column:
        first, second = (F.instr(lowered, mark) for mark in CITY_MARKS)
        return (
            F.when(first > 0, F.substring(lowered, first + len(CITY_MARKS[0]), F.length(lowered)))
            .when(second > 0, F.substring(lowered, second + len(CITY_MARKS[1]), F.length(lowered)))
            .otherwise(lowered)
        )

    def street(rest: Column) -> Column:
        return (
            F.when(rest.rlike(STREET), strip(F.regexp_extract(rest, STREET, 1)))
            .when(F.instr(rest, ",") > 0, strip(F.substring_index(rest, ",", 1)))
            .otherwise(rest)
        )

    return let(let(F.lower(F.coalesce(address, F.lit(""))), behind_city), street)


def file_name(value: Column) -> Column:
    """Name safe for a file: ``[a-z0-9_-]`` only, runs of ``_`` squeezed, 100 characters at most."""
    safe = F.regexp_replace(F.regexp_replace(F.lower(strip(value)), r"[^a-z0-9_\-]", "_"), "_+", "_")
    return F.when(F.coalesce(value, F.lit("")) == "", F.lit("unnamed")).otherwise(
        F.substring(F.btrim(safe, F.lit("_")), 1, 100)
    )


def variant_label(index: Column) -> Column:
    """0, 1, .. 25, 26, .. as A, B, .. Z, AA, ..; twelve letters cover every long that occurs."""
    number = index.cast("long")
    label, start = None, 0
    for size in range(1, 13):
        letters = [
            F.char(F.lit(65) + F.pmod(F.floor((number - start) / 26**place), F.lit(26))) for place in range(size - 1, -1, -1)
        ]
        start += 26**size
        option = F.concat(*letters)
        label = F.when(number < start, option) if label is None else label.when(number < start, option)
    return label


def escape_markdown(value: Column) -> Column:
    return F.regexp_replace(F.coalesce(value, F.lit("")), r"([|\[\]()])", r"\\$1")


def longest(*values: Column) -> Column:
    """Longest stripped value of a row, the first one on ties, empty when there is none."""
    options = [
        F.struct(F.length(strip(v)).alias("size"), F.lit(-i).alias("rank"), strip(v).alias("value"))
        for i, v in enumerate(values)
    ]
    best = F.array_max(F.filter(F.array(*options), lambda o: o["size"] > 0))
    return F.coalesce(best["value"], F.lit(""))


def words_alternation(words: tuple[str, ...]) -> str:
    """Pattern matching any of the plain words."""
    return "|".join("".join("\\" + ch if ch in r"\.[]{}()*+-?^$|" else ch for ch in word) for word in words)


def contains_any(value: Column, words: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(value, F.lit(word)) for word in words])
