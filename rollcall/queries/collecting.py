"""Listings from JSON-LD pages, search answers, listing cards and page texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollcall.functions.urls import next_page_url, page_number
from rollcall.operators.picking import with_dense_ids
from rollcall.operators.stages import collection_counts, collection_gaps
from rollcall.queries import register
from rollcall.queries.base import joined, listing_sql, messenger_text, with_joined_lists
from rollcall.schema import with_null_defaults
from rollcall.scratch import keep, scratch_path
from rollcall.sinks.tables import append_listings
from rollcall.sources import derived_pages
from rollcall.sources.cards import COMPANY_PAGE, DIRECTORY_FIRMS, DIRECTORY_MAP, DIRECTORY_PAGES, cards_of, company_page_links, union_sources
from rollcall.sources.driver_tables import dealt_listings, listings, shape_listings, table
from rollcall.sources.jsonld import declared_totals, listed_businesses, local_listings
from rollcall.sources.registry import collect_sources
from rollcall.sources.search import detail_rows, recover_json, search_listings, search_queries, with_details
from rollcall.streaming.ingest import ingest

PHONE_TEXT = "coalesce((SELECT string_agg(phone, ';' ORDER BY pos) FROM phone p WHERE p.id = {0}), '')"

JSONLD = """
item AS (
    SELECT id, city, id // 200 + 1 AS page, name, website,
           CASE id % 6 WHEN 0 THEN 'Elsewhere' WHEN 1 THEN '' WHEN 2 THEN lower(city) ELSE city END AS locality,
           CASE WHEN id % 4 <> 0 THEN 'https://org.example.ru/' || (id // 3) END AS org_url,
           CASE WHEN id % 5 >= 2 THEN '5' || (id % 10) || '.5' END AS lat, '3' || (id % 7) || '.25' AS lon
    FROM listings WHERE id % 10 <> 9
),
twice AS (SELECT i.*, b.block FROM item i, (SELECT 0 AS block UNION ALL SELECT 3) b),
local AS (SELECT * FROM twice WHERE locality <> 'Elsewhere'),
once AS (
    SELECT id, block FROM local WHERE org_url IS NULL
    UNION ALL
    SELECT id, block FROM (SELECT id, block, row_number() OVER (PARTITION BY city, org_url ORDER BY page, block, id) AS r FROM local WHERE org_url IS NOT NULL) WHERE r = 1
)
"""

JSONLD_COLUMNS = """
city, page, block, 'https://dir.example.ru/' || lower(city) || '/?page=' || page AS source_url, name,
       coalesce((SELECT string_agg(phone, ';' ORDER BY pos) FROM phone p WHERE p.id = t.id), '') AS phones,
       'Street ' || t.id || CASE WHEN locality <> '' THEN ', ' || locality ELSE '' END AS address_raw, website,
       lat::DOUBLE AS lat, CASE WHEN lat IS NOT NULL THEN lon::DOUBLE END AS lon, org_url"""


def _jsonld_columns(df):
    return df.select(
        "city",
        "page",
        F.col("block").cast("int").alias("block"),
        "source_url",
        "name",
        joined("phones").alias("phones"),
        "address_raw",
        "website",
        F.col("geo.lat").alias("lat"),
        F.col("geo.lon").alias("lon"),
        "org_url",
    )


@register("listed_businesses", listing_sql(f"SELECT {JSONLD_COLUMNS} FROM twice t", JSONLD))
def _(spark, folder):
    return _jsonld_columns(listed_businesses(derived_pages.directory_pages(listings(spark, folder))))


@register("local_listings", listing_sql(f"SELECT {JSONLD_COLUMNS} FROM local t SEMI JOIN once o USING (id, block)", JSONLD))
def _(spark, folder):
    return _jsonld_columns(local_listings(derived_pages.directory_pages(listings(spark, folder))))


@register(
    "declared_totals",
    listing_sql("SELECT city, id // 200 + 1 AS page, count(*)::INTEGER AS total FROM listings GROUP BY ALL"),
)
def _(spark, folder):
    pages = derived_pages.directory_pages(listings(spark, folder)).withColumn("category", F.col("city"))
    return declared_totals(pages).select(F.col("category").alias("city"), "page", "total")


@register(
    "collection_gaps",
    listing_sql(
        """
, total AS (SELECT city, count(*) AS declared FROM listings GROUP BY city, id // 200 QUALIFY row_number() OVER (PARTITION BY city ORDER BY id // 200) = 1),
got AS (SELECT city, count(*) AS collected FROM local SEMI JOIN once USING (id, block) GROUP BY city)
SELECT city, coalesce(collected, 0) AS collected, declared::INTEGER AS declared, greatest(declared - coalesce(collected, 0), 0) AS missing
FROM total LEFT JOIN got USING (city)""".replace("\n, total", "\n, total", 1),
        JSONLD,
    ),
)
def _(spark, folder):
    pages = derived_pages.directory_pages(listings(spark, folder)).withColumn("category", F.col("city"))
    return collection_gaps(local_listings(pages), declared_totals(pages)).withColumnRenamed("category", "city")


@register(
    "next_pages",
    listing_sql(
        """
SELECT DISTINCT city, id // 200 + 1 AS page,
       CASE WHEN (id // 200) % 2 = 0 THEN 'https://dir.example.ru/next/' || (id // 200)
            ELSE 'https://dir.example.ru/' || lower(city) || '/?page=' || (id // 200 + 2) END AS next_url FROM listings"""
    ),
)
def _(spark, folder):
    pages = derived_pages.directory_pages(listings(spark, folder))
    return pages.select("city", "page", next_page_url(F.col("html"), F.col("url"), page_number(F.col("url"))).alias("next_url"))


@register(
    "search_listings",
    listing_sql(
        """
, h AS (SELECT id, city, lower(split_part(name, ' ', 1)) AS word FROM listings WHERE id % 8 NOT IN (0, 1))
SELECT id, city, 0 AS pos, 'https://portal.example.ru/' || (id // 5) AS website, 'Portal' AS name, 'firecrawl' AS source FROM h
UNION ALL SELECT id, city, 1, 'https://found' || id || '.example.ru', CASE id % 3 WHEN 0 THEN 'About ' || word ELSE 'Other' END, 'firecrawl'
          FROM h WHERE id % 11 <> 0 AND id % 3 <> 2
UNION ALL SELECT id, city, 2, 'https://third' || id || '.example.ru', word || ' LLC', 'firecrawl' FROM h"""
    ),
)
def _(spark, folder):
    answers = derived_pages.search_answers(listings(spark, folder)).drop("name")
    return search_listings(answers).select("id", "city", "pos", "website", "name", "source")


@register(
    "domain_details",
    listing_sql(
        r"""
, h AS (SELECT id, city, id * 10 AS pos, 'https://portal.example.ru/' || (id // 5) AS website FROM listings WHERE id % 8 NOT IN (0, 1)
        UNION ALL SELECT id, city, id * 10 + 1, 'https://found' || id || '.example.ru' FROM listings WHERE id % 8 NOT IN (0, 1) AND id % 11 <> 0 AND id % 3 <> 2
        UNION ALL SELECT id, city, id * 10 + 2, 'https://third' || id || '.example.ru' FROM listings WHERE id % 8 NOT IN (0, 1))
SELECT pos, website, CASE WHEN seen THEN '749512345' || lpad((id % 100)::VARCHAR, 2, '0') ELSE '' END AS phones,
       CASE WHEN seen THEN 'box' || id || '@example.ru' ELSE '' END AS emails, CASE WHEN seen THEN 'г. Тверь, ул. Мира' ELSE '' END AS address_raw
FROM (SELECT *, starts_with(website, 'https://found') AND id % 6 < 4 AS seen FROM h)"""
    ),
)
def _(spark, folder):
    rows = listings(spark, folder)
    answers = derived_pages.search_answers(rows).drop("name")
    found = search_listings(answers).withColumn("pos", F.col("id") * 10 + F.col("pos"))
    details = detail_rows(derived_pages.noisy_outputs(rows))
    again = details.withColumn("emails", F.array().cast("array<string>"))
    return with_joined_lists(with_details(found, details.unionByName(again)), "phones", "emails").select("pos", "website", "phones", "emails", "address_raw")


@register(
    "page_details",
    listing_sql(
        """
SELECT id, '+7 (495) 123-45-' || lpad((id % 100)::VARCHAR, 2, '0') AS phones, 'box' || id || '@example.ru' AS emails,
       'г. Тверь, ул. Мира;г. Тверь, Лесная 5' AS addresses FROM listings WHERE id % 6 < 4"""
    ),
)
def _(spark, folder):
    outputs = derived_pages.noisy_outputs(listings(spark, folder))
    rows = detail_rows(outputs.withColumn("url", F.col("id").cast("string")))
    return with_joined_lists(rows, "phones", "emails", "addresses").select(
        F.col("url").cast("long").alias("id"), "phones", "emails", "addresses"
    )


@register(
    "recovered_json",
    """
WITH noisy AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN props WHEN 1 THEN 'log: ' || props || ' end' WHEN 2 THEN 'a {bad} ' || event_id
                      WHEN 3 THEN '{"o": ' || props || '}' ELSE '' END AS body, props FROM events)
SELECT event_id, CASE event_id % 5 WHEN 0 THEN props WHEN 1 THEN props WHEN 3 THEN body END AS found,
       CASE event_id % 5 WHEN 0 THEN (props->>'$.k')::BIGINT WHEN 1 THEN (props->>'$.k')::BIGINT END AS k FROM noisy""",
)
def _(spark, folder):
    key, props = F.col("event_id") % 5, F.col("props")
    body = (
        F.when(key == 0, props)
        .when(key == 1, F.concat(F.lit("log: "), props, F.lit(" end")))
        .when(key == 2, F.concat(F.lit("a {bad} "), F.col("event_id").cast("string")))
        .when(key == 3, F.concat(F.lit('{"o": '), props, F.lit("}")))
        .otherwise("")
    )
    found = table(spark, folder, "events").select("event_id", recover_json(body).alias("found"))
    return found.select("event_id", "found", F.get_json_object("found", "$.k").try_cast("long").alias("k"))


CARD = r"""
card AS (
    SELECT id, city, 'https://dir.example.ru/p/' || (id // 2) AS url, CASE WHEN id % 12 = 5 THEN 'ab' ELSE name END AS name, address_raw, website, phones,
           CASE WHEN id % 3 = 1 THEN 'https://t.me/shop' || id ELSE 'https://t.me/old' END AS tg, CASE WHEN id % 5 = 3 THEN 'https://vk.com/shop' || id END AS vk,
           CASE WHEN id % 7 = 0 THEN 'https://instagram.com/shop' || id END AS ig,
           (SELECT list(p ORDER BY q.pos) FROM phone_values q WHERE q.id = l.id AND length(p) = 11 AND p[1] = '7' AND q.pos <= 2) AS two,
           (SELECT max(p) FROM phone_values q WHERE q.id = l.id AND length(p) = 11 AND p[1] = '7' AND q.pos = 1) AS one
    FROM listings l
)
"""
TWO = "coalesce(array_to_string(list_filter(two, lambda x, i: list_position(two, x) = i), ';'), '')"


def _cards(df):
    rows = df.withColumn("messengers", messenger_text())
    return with_joined_lists(rows, "phones", "emails").drop("pos")


@register(
    "map_cards",
    listing_sql(
        """
SELECT city, '2gis' AS source, url, 'https://dir.example.ru/firm/' || id AS source_url, name, coalesce(one, '') AS phones, address_raw,
       NULL AS website, '' AS emails, concat_ws(';', 'instagram=' || ig, 'telegram=' || tg, 'vk=' || vk) AS messengers
FROM card WHERE length(name) >= 3""",
        CARD,
    ),
)
def _(spark, folder):
    return _cards(cards_of(derived_pages.card_pages(listings(spark, folder), "map"), DIRECTORY_MAP))


@register(
    "page_cards",
    listing_sql(
        """
SELECT city, 'yell' AS source, url, url AS source_url, name, coalesce(one, '') AS phones, address_raw,
       CASE WHEN id % 2 = 0 THEN coalesce(website, '/inner') ELSE 'https://t.me/old' END AS website,
       'box' || id || '@example.ru' AS emails, concat_ws(';', 'telegram=' || tg, 'vk=' || vk) AS messengers
FROM card WHERE length(name) >= 3""",
        CARD,
    ),
)
def _(spark, folder):
    return _cards(cards_of(derived_pages.card_pages(listings(spark, folder), "pages"), DIRECTORY_PAGES))


@register(
    "firm_cards",
    listing_sql(
        f"""
SELECT city, 'firmsru' AS source, url, url AS source_url, name, {TWO} AS phones, address_raw, 'https://t.me/old' AS website,
       'box' || id || '@example.ru' AS emails, concat_ws(';', 'telegram=' || tg, 'vk=' || vk) AS messengers
FROM card WHERE length(name) >= 3""",
        CARD,
    ),
)
def _(spark, folder):
    return _cards(cards_of(derived_pages.card_pages(listings(spark, folder), "firms"), DIRECTORY_FIRMS))


@register(
    "company_pages",
    listing_sql(
        f"""
SELECT city, 'jsprav_playwright' AS source, 'https://dir.example.ru/c/' || id AS url, 'https://dir.example.ru/c/' || id AS source_url, name,
       {TWO} AS phones, address_raw, CASE WHEN contains(website, 'http') THEN website ELSE 'https://t.me/old' END AS website,
       'box' || id || '@example.ru' AS emails, concat_ws(';', 'telegram=' || tg, 'vk=' || vk) AS messengers
FROM card""",
        CARD,
    ),
)
def _(spark, folder):
    return _cards(cards_of(derived_pages.card_pages(listings(spark, folder), "company"), COMPANY_PAGE))


@register(
    "company_page_links",
    r"""
WITH link AS (SELECT regexp_extract(url, '^[^:/?#]+://[^/?#]*') AS root, unnest(regexp_extract_all(html, '(?is)<a\s[^>]*href=["'']([^"'']+)["'']', 1)) AS href FROM pages)
SELECT DISTINCT root || '/shops' || href AS url FROM link WHERE NOT suffix(rtrim(href, '/'), 'shops')""",
)
def _(spark, folder):
    pages = table(spark, folder, "pages").select(
        F.lit("all").alias("city"), "url", F.replace("html", F.lit('href="/'), F.lit('href="/shops/')).alias("html")
    )
    return company_page_links(pages, "shops").select("url")


@register(
    "united_sources",
    listing_sql(
        """
SELECT city, source, name, address_raw, count(*) AS listings FROM (
    SELECT city, '2gis' AS source, name, address_raw FROM card WHERE length(name) >= 3
    UNION ALL SELECT city, 'firmsru', name, address_raw FROM card WHERE length(name) >= 3
    UNION ALL SELECT city, 'jsprav_playwright', name, address_raw FROM card
    UNION ALL SELECT city, 'yell', name, address_raw FROM card WHERE length(name) >= 3
    UNION ALL SELECT city, 'jsprav', name, 'Street ' || id || CASE WHEN locality <> '' THEN ', ' || locality ELSE '' END FROM local SEMI JOIN once USING (id, block))
GROUP BY ALL""",
        CARD,
        JSONLD,
    ),
)
def _(spark, folder):
    rows = listings(spark, folder)
    kinds = (("map", DIRECTORY_MAP), ("pages", DIRECTORY_PAGES), ("firms", DIRECTORY_FIRMS), ("company", COMPANY_PAGE))
    tables = [cards_of(derived_pages.card_pages(rows, kind), rules) for kind, rules in kinds]
    united = union_sources(*tables, local_listings(derived_pages.directory_pages(rows)))
    return united.groupBy("city", "source", "name", "address_raw").agg(F.count(F.lit(1)).alias("listings"))


@register(
    "collected_sources",
    listing_sql(
        """
, row AS (
    SELECT city, '2gis' AS source, name FROM card WHERE length(name) >= 3 UNION ALL SELECT city, 'firmsru', name FROM card WHERE length(name) >= 3
    UNION ALL SELECT city, 'jsprav', name FROM local SEMI JOIN once USING (id, block)
    UNION ALL SELECT city, 'firecrawl', unnest(['Portal', CASE WHEN id % 11 <> 0 AND id % 3 <> 2 THEN CASE id % 3 WHEN 0 THEN 'About ' || lower(split_part(name, ' ', 1)) ELSE 'Other' END END,
                                                lower(split_part(name, ' ', 1)) || ' LLC']) FROM listings WHERE id % 8 NOT IN (0, 1))
SELECT city, source, name, count(*) AS listings, 'firmsru;jsprav_playwright' AS failed FROM row WHERE name IS NOT NULL AND source <> 'firmsru' GROUP BY ALL""",
        CARD,
        JSONLD,
    ),
)
def _(spark, folder):
    """All sources but one that is off, one whose input is missing, and one that fails while it runs."""
    rows = dealt_listings(spark, folder)
    broken = derived_pages.card_pages(rows, "firms").withColumn("html", F.when(F.raise_error(F.lit("page lost")).isNull(), F.col("html")))
    inputs = {
        "jsprav": derived_pages.directory_pages(rows),
        "dgis": derived_pages.card_pages(rows, "map"),
        "firmsru": broken,
        "firecrawl": derived_pages.search_answers(rows).select("city", F.col("id").cast("string").alias("query"), "body"),
        "fetched": derived_pages.noisy_outputs(rows),
    }
    united, errors = collect_sources(inputs, {"yell": {"enabled": False}})
    return united.groupBy("city", "source", "name").agg(F.count(F.lit(1)).alias("listings"), F.lit(";".join(sorted(errors))).alias("failed"))


@register(
    "listing_ids",
    listing_sql("SELECT city, count(*) AS listings, count(*) AS ids, true AS inside FROM listings GROUP BY city"),
)
def _(spark, folder):
    """Listings without ids get dense ones; every id from 0 to the count is given once."""
    rows = keep(with_dense_ids(listings(spark, folder).drop("id")), "numbered").df
    last = rows.agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top"), F.countDistinct("id").alias("distinct")).first()
    whole = last["top"] == last["n"] - 1 and last["distinct"] == last["n"]
    return rows.groupBy("city").agg(
        F.count(F.lit(1)).alias("listings"), F.countDistinct("id").alias("ids"), F.lit(whole).alias("inside")
    )


@register(
    "null_defaults",
    listing_sql(
        "SELECT id, CASE WHEN website IS NULL THEN 0 ELSE len(phones) END AS phones, len(emails) AS emails, (telegram IS NOT NULL)::INTEGER + (vk IS NOT NULL)::INTEGER + (whatsapp IS NOT NULL)::INTEGER AS links FROM listings"
    ),
)
def _(spark, folder):
    rows = listings(spark, folder).withColumns(
        {
            "phones": F.when(F.col("website").isNotNull(), F.col("phones")),
            "emails": F.when(F.size("emails") > 0, F.col("emails")),
            "messengers": F.when(F.size("messengers") > 0, F.col("messengers")),
        }
    )
    filled = with_null_defaults(rows)
    return filled.select("id", F.size("phones").alias("phones"), F.size("emails").alias("emails"), F.size("messengers").alias("links"))


@register(
    "search_queries",
    listing_sql("SELECT DISTINCT city, phrase || ' ' || region AS query FROM listings, (SELECT unnest(['monuments', 'stone works']) AS phrase)"),
)
def _(spark, folder):
    return search_queries(listings(spark, folder).select("city", "region").distinct(), ("monuments", "stone works"))


@register(
    "ingested_listings",
    listing_sql("SELECT city, source_url, min(id) AS id FROM listings GROUP BY ALL"),
)
def _(spark, folder):
    """Customers arrive as a file stream, become listings, and each address is taken in once."""
    customers = (
        spark.readStream.schema(table(spark, folder, "customer").schema).option("pathGlobFilter", "customer.parquet").parquet(folder)
    )
    stream = shape_listings(customers, table(spark, folder, "nation"), table(spark, folder, "region"))
    timed = stream.withColumn("scraped_at", F.timestamp_seconds(F.lit(1_700_000_000)))
    target = scratch_path(spark, "ingested")
    ingest(timed, target, scratch_path(spark, "ingest-state"))
    return spark.read.parquet(target).select("city", "source_url", "id")


@register(
    "appended_listings",
    listing_sql("SELECT id, city, source, name, unnest([1, 1]) AS copy FROM listings"),
)
def _(spark, folder):
    """The same listings appended twice to a table kept by city."""
    target = scratch_path(spark, "raw")
    rows = keep(listings(spark, folder), "listings").df
    append_listings(rows, target)
    append_listings(rows, target)
    return spark.read.parquet(target).select("id", "city", "source", "name", F.lit(1).alias("copy"))
