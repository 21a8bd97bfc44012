"""Search answers and page details delivered as JSON or plain text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.binding import let, rows_with
from rollcall.functions.emails import emails_in_text
from rollcall.functions.html import every, first
from rollcall.functions.phones import normalize_phones, phones_in_text
from rollcall.functions.urls import domain_of
from rollcall.operators.gaps import one_per_page
from rollcall.operators.picking import first_per_key
from rollcall.schema import no_messengers, no_strings
from rollcall.settings import SEARCH_PHRASES

SEARCH = "data struct<web: array<struct<url: string, title: string, description: string>>>"

# Fixed value: an object with at most one level of objects inside it.
FIRST_OBJECT = r"\{(?:[^{}]|\{[^{}]*\})*\}"

# Addresses in running text.
ADDRESSES = (
    r"г\.?\s+[А-Яа-яё]+\s*,?\s*ул\.?\s+[А-Яа-яё]+",
    r"г\.?\s+[А-Яа-яё]+\s*,?\s*[А-Яа-яё]+\s+\d+",
)

# Fixed value: plain text counts as a page only from this length on.
SHORTEST_TEXT = 50


def recover_json(output: Column) -> Column:
    """The text when it is JSON, else its first object when that is JSON, else null."""

    def if_json(text: Column) -> Column:
        return F.when((text != "") & F.try_parse_json(text).isNotNull(), text)

    return F.coalesce(
        let(F.trim(output), if_json), let(F.regexp_extract(output, FIRST_OBJECT, 0), if_json)
    )


def search_results(answers: DataFrame, limit: int | None = None) -> DataFrame:
    """(all columns but body, pos, url, title, description) from stored answers with a JSON ``body``."""
    carried = [c for c in answers.columns if c != "body"]
    hits = F.from_json(recover_json(F.col("body")), SEARCH)["data"]["web"]
    if limit is not None:
        hits = F.slice(hits, 1, limit)
    return answers.select(*carried, F.posexplode(hits).alias("pos", "hit")).select(*carried, "pos", "hit.*")


def search_listings(answers: DataFrame, limit: int | None = None) -> DataFrame:
    """Hits with an address and a title as listings: the title is the name, the address the website.

    ``limit`` takes that many hits of each answer only, as a search with a limit would have returned.
    """
    found = search_results(answers, limit).where("url != '' and title != ''")
    return found.select(
        *[c for c in answers.columns if c != "body"],
        "pos",
        F.lit("firecrawl").alias("source"),
        F.col("url").alias("source_url"),
        F.col("title").alias("name"),
        F.col("url").alias("website"),
    )


def search_queries(regions: DataFrame, phrases: tuple[str, ...] = SEARCH_PHRASES) -> DataFrame:
    """(city, query): every configured phrase with the region, or with the city itself when it has none."""
    place = F.coalesce("region", "city")
    phrase = F.explode(F.array(*[F.lit(p) for p in phrases]))
    return regions.select("city", place.alias("place"), phrase.alias("phrase")).select(
        "city", F.concat_ws(" ", "phrase", "place").alias("query")
    )


def page_body(output: Column) -> Column:
    """Text of a fetched page: markdown or html inside JSON, else the plain output when it is long enough."""

    def plain(data: Column) -> Column:
        return F.when(~F.startswith(data, F.lit("{")) & ~F.startswith(data, F.lit("[")), F.nullif(data, F.lit("")))

    def body(json: Column) -> Column:
        inside = F.coalesce(
            F.nullif(F.get_json_object(json, "$.data.markdown"), F.lit("")),
            F.nullif(F.get_json_object(json, "$.data.html"), F.lit("")),
            let(F.get_json_object(json, "$.data"), plain),
        )
        text = F.trim(output)
        return F.when(json.isNotNull(), inside).when(F.length(text) > SHORTEST_TEXT, text)

    return let(recover_json(output), body)


def text_details(text: Column, country: str = "7", plus_optional: bool = True) -> dict[str, Column]:
    """Phones as written, e-mails and addresses of a text."""
    return {
        "phones": phones_in_text(text, country, plus_optional),
        "emails": emails_in_text(text),
        "addresses": F.concat(*[every(text, pattern, 0) for pattern in ADDRESSES]),
    }


def detail_rows(pages: DataFrame) -> DataFrame:
    """(url, phones, emails, addresses) of stored pages with a text."""
    bodies = pages.select("url", rows_with(page_body(F.col("output"))).alias("text"))
    return bodies.select("url", *[column.alias(name) for name, column in text_details(F.col("text")).items()])


def with_details(listings: DataFrame, details: DataFrame, order: str = "pos") -> DataFrame:
    """Gives the details of its page to the first listing of every domain; the others stay without."""
    keyed = listings.withColumn("domain", domain_of(F.col("website")))
    sited = listings.select(rows_with(domain_of(F.col("website"))).alias("domain"), order, F.col("website").alias("url"))
    firsts = first_per_key(sited, ["domain"], order)
    found = firsts.join(one_per_page(details), "url").select(
        "domain", F.col(order).alias("first"), "phones", "emails", "addresses"
    )
    is_first = (keyed["domain"] == found["domain"]) & (keyed[order] == found["first"])
    return keyed.join(found, is_first, "left").select(
        *[keyed[c] for c in listings.columns],
        F.coalesce(normalize_phones(found["phones"]), no_strings()).alias("phones"),
        F.coalesce(found["emails"], no_strings()).alias("emails"),
        F.coalesce(first(found["addresses"]), F.lit("")).alias("address_raw"),
        no_messengers().alias("messengers"),
    )
