"""Business listings embedded in directory pages as JSON-LD."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.binding import let
from rollcall.functions.html import every, without_tags
from rollcall.functions.phones import normalize_phones
from rollcall.functions.places import geo_point, is_local
from rollcall.operators.picking import first_per_key
from rollcall.schema import no_messengers, no_strings

SCRIPT = r"""(?is)<script[^>]*type=["']application/ld\+json["'][^>]*>(.*?)</script>"""

ITEM_LIST = """
    `@type` string,
    itemListElement array<struct<item: struct<
        `@type`: string, name: string, url: string,
        telephone: array<string>, sameAs: array<string>,
        address: struct<streetAddress: string, addressLocality: string>,
        geo: struct<latitude: string, longitude: string>>>>
"""


def listed_businesses(pages: DataFrame) -> DataFrame:
    """Every business of every item list on the pages, in page order. Broken JSON gives no rows.

    ``pages`` holds (category, city, page, url, html).
    """
    bodies = pages.select(
        "category", "city", "page", F.col("url").alias("source_url"), F.posexplode(every(F.col("html"), SCRIPT)).alias("block", "body")
    )
    parsed = F.from_json(F.when(F.startswith(F.ltrim("body"), F.lit("{")), F.col("body")), ITEM_LIST)
    elements = let(parsed, lambda found: F.when(found["@type"] == "ItemList", found["itemListElement"]))
    items = bodies.select("category", "city", "page", "source_url", "block", F.posexplode(elements).alias("pos", "element"))
    item = F.col("element.item")
    street = F.coalesce(item["address"]["streetAddress"], F.lit(""))
    locality = F.coalesce(item["address"]["addressLocality"], F.lit(""))
    return items.where((item["@type"] == "LocalBusiness") & (item["name"] != "")).select(
        "category",
        "city",
        "page",
        "block",
        "pos",
        "source_url",
        F.lit("jsprav").alias("source"),
        item["name"].alias("name"),
        normalize_phones(item["telephone"]).alias("phones"),
        F.btrim(F.concat(street, F.lit(", "), locality), F.lit(", ")).alias("address_raw"),
        F.get(item["sameAs"], 0).alias("website"),
        no_strings().alias("emails"),
        geo_point(item["geo"]["latitude"], item["geo"]["longitude"]).alias("geo"),
        no_messengers().alias("messengers"),
        locality.alias("locality"),
        F.nullif(item["url"], F.lit("")).alias("org_url"),
    )


def local_listings(pages: DataFrame) -> DataFrame:
    """Businesses of the page's own city, each organisation address once per category.

    Foreign rows are dropped first, so they do not use up an address; rows without an address all stay.
    """
    local = listed_businesses(pages).where(is_local(F.col("locality"), F.col("city")))
    own_key = F.concat_ws("#", F.lit(""), "source_url", "page", "block", "pos")
    keyed = local.withColumn("listing_key", F.coalesce("org_url", own_key))
    return first_per_key(keyed, ["category", "city", "listing_key"], "page", "block", "pos").select(*local.columns)


def declared_total(html: Column) -> Column:
    """Number of companies the benefits block of a directory page states, or null."""
    block = F.regexp_extract(html, r"""(?is)<div[^>]*class=["'](?:[^"']*\s)?cat-benefits(?:\s[^"']*)?["'][^>]*>(.*?)</div>""", 1)
    points = F.transform(every(block, r"(?is)<li[^>]*>(.*?)</li>"), without_tags)
    numbers = F.transform(points, lambda text: F.regexp_extract(text, r"(\d+)\s+компани", 1).try_cast("int"))
    return F.get(F.filter(numbers, lambda n: n.isNotNull()), 0)


def declared_totals(pages: DataFrame) -> DataFrame:
    return pages.select("category", "page", declared_total(F.col("html")).alias("total"))
