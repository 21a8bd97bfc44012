"""Listing sources by name: each turns its stored input into listing rows.

A new source is a function from inputs to listings under ``@source("name")``.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.schema import LISTING
from rollcall.scratch import keep
from rollcall.sources.cards import COMPANY_PAGE, DIRECTORY_FIRMS, DIRECTORY_MAP, DIRECTORY_PAGES, cards_of
from rollcall.sources.jsonld import local_listings
from rollcall.sources.search import detail_rows, search_listings, with_details

log = logging.getLogger(__name__)

Inputs = dict[str, DataFrame]
Reader = Callable[[Inputs], DataFrame]

READERS: dict[str, Reader] = {}


def source(name: str) -> Callable[[Reader], Reader]:
    def add(reader: Reader) -> Reader:
        READERS[name] = reader
        return reader

    return add


@source("jsprav")
def _(inputs: Inputs) -> DataFrame:
    """``jsprav``: (category, city, page, url, html)."""
    return local_listings(inputs["jsprav"])


@source("firecrawl")
def _(inputs: Inputs) -> DataFrame:
    """``firecrawl``: (city, query, body) search answers; ``fetched``: (url, output) page texts."""
    answers = inputs["firecrawl"]
    place = F.concat_ws("#", "city", "query", F.lpad(F.col("pos").cast("string"), 6, "0"))
    found = search_listings(answers).withColumn("place", place)
    return with_details(found, detail_rows(inputs["fetched"]), order="place")


for _name, _rules in (
    ("dgis", DIRECTORY_MAP),
    ("yell", DIRECTORY_PAGES),
    ("firmsru", DIRECTORY_FIRMS),
    ("jsprav_playwright", COMPANY_PAGE),
):
    READERS[_name] = lambda inputs, name=_name, rules=_rules: cards_of(inputs[name], rules)


def as_listings(rows: DataFrame) -> DataFrame:
    """The listing columns but the id; columns a source lacks are null."""
    return rows.select(
        *[
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in LISTING.fields
            if f.name != "id"
        ]
    )


def collect_sources(
    inputs: Inputs, flags: dict[str, dict] | None = None, names: tuple[str, ...] | None = None
) -> tuple[DataFrame | None, dict[str, str]]:
    """Listings of all sources that are on, in one table, and the error of each source that failed.

    A source is on unless its flag says otherwise. Each is read and written to scratch on its own, so one that fails, while
    it is planned or while it runs, does not stop the others.
    """
    tables, errors = [], {}
    for name in names or tuple(READERS):
        if not (flags or {}).get(name, {}).get("enabled", True):
            continue
        try:
            tables.append(keep(as_listings(READERS[name](inputs)), f"source-{name}").df)
        except Exception as error:
            log.warning("source %s failed: %s", name, error)
            errors[name] = f"{type(error).__name__}: {error}"
    return (reduce(DataFrame.unionByName, tables) if tables else None), errors
