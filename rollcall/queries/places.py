"""Regions, localities, subdomains, collection addresses and stages."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollcall.functions.places import is_local
from rollcall.functions.texts import directory_subdomain
from rollcall.operators.places import (
    active_sources,
    best_localities,
    extend_cache,
    known_categories,
    listing_urls,
    region_cities,
    region_totals,
    relabel_scope,
    resolve_subdomains,
    search_urls,
    still_unknown,
)
from rollcall.operators.stages import collection_counts, stage_by_city
from rollcall.queries import register
from rollcall.queries.base import listing_sql
from rollcall.sources.driver_tables import listings, table


def nation_region(spark, folder):
    joined = table(spark, folder, "nation").join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select(F.col("n_name").alias("name"), F.col("r_name").alias("region"), F.col("n_nationkey").alias("n"))


@register(
    "region_cities",
    """
WITH dim AS (SELECT n_name AS name, n_nationkey AS n, CASE WHEN n_nationkey % 6 = 5 THEN '' ELSE r_name END AS region
             FROM nation JOIN region ON n_regionkey = r_regionkey),
town AS (SELECT n_name AS town, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_regionkey <> 2),
wanted AS (SELECT DISTINCT n_name AS city FROM customer JOIN nation ON n_nationkey = c_nationkey UNION SELECT 'Nowhere'),
own AS (SELECT city, nullif(region, '') AS region FROM wanted LEFT JOIN dim ON name = city)
SELECT city, town FROM own JOIN town USING (region)
UNION ALL SELECT city, name FROM own JOIN dim USING (region) WHERE region NOT IN (SELECT region FROM town)
UNION ALL SELECT city, city FROM own WHERE region IS NULL""",
)
def _(spark, folder):
    nations = nation_region(spark, folder)
    cities = nations.select("name", F.when(F.col("n") % 6 == 5, "").otherwise(F.col("region")).alias("region"))
    towns = nations.where("region <> 'ASIA'").select("region", F.col("name").alias("town"))
    customers = table(spark, folder, "customer").join(nations, F.col("c_nationkey") == F.col("n"))
    wanted = customers.select(F.col("name").alias("city")).distinct().union(spark.range(1).select(F.lit("Nowhere")))
    return region_cities(wanted, cities, towns)


@register(
    "region_totals",
    "SELECT count(DISTINCT r_name) AS regions, count(*) AS towns FROM nation JOIN region ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey",
)
def _(spark, folder):
    nations = nation_region(spark, folder)
    customers = table(spark, folder, "customer").join(nations, F.col("c_nationkey") == F.col("n"))
    return region_totals(customers.select("region", F.col("name").alias("town")))


@register(
    "relabelled_scopes",
    listing_sql(
        """
SELECT id, CASE WHEN region = 'ASIA' THEN city WHEN region = 'EUROPE' THEN 'EAST' ELSE region END AS city FROM listings
UNION ALL SELECT id + 1125899906842624, region FROM listings WHERE region = 'EUROPE'"""
    ),
)
def _(spark, folder):
    """Towns of one wanted city each, but those of one region, which count to two."""
    nations = nation_region(spark, folder).where("region <> 'ASIA'")
    towns = nations.select(F.col("name").alias("town"), F.col("region").alias("city"))
    towns = towns.unionByName(towns.where("city = 'EUROPE'").withColumn("city", F.lit("EAST")))
    return relabel_scope(listings(spark, folder).select("id", "city"), towns)


LOCALITY = """
place AS (
    SELECT id, city, CASE id % 6 WHEN 0 THEN '' WHEN 1 THEN city WHEN 2 THEN lower(city) || 'а' WHEN 3 THEN substr(city, 1, 7)
                                 WHEN 4 THEN 'NATION_' || (id % 25) ELSE city || 'ая' END AS locality,
           CASE WHEN id % 4 = 3 THEN city || 'ью' ELSE city END AS wanted
    FROM listings
)
"""


@register(
    "local_addresses",
    listing_sql(
        """
SELECT id, locality = '' OR starts_with(lower(wanted), lower(locality)) OR starts_with(lower(locality), lower(wanted))
       OR (length(locality) > 4 AND rtrim(lower(locality), 'аеоуияью') <> '' AND rtrim(lower(locality), 'аеоуияью') = rtrim(lower(wanted), 'аеоуияью')) AS is_local
FROM place""",
        LOCALITY,
    ),
)
def _(spark, folder):
    key, city = F.col("id") % 6, F.col("city")
    locality = (
        F.when(key == 0, "")
        .when(key == 1, city)
        .when(key == 2, F.concat(F.lower(city), F.lit("а")))
        .when(key == 3, F.substring(city, 1, 7))
        .when(key == 4, F.concat(F.lit("NATION_"), (F.col("id") % 25).cast("string")))
        .otherwise(F.concat(city, F.lit("ая")))
    )
    wanted = F.when(F.col("id") % 4 == 3, F.concat(city, F.lit("ью"))).otherwise(city)
    return listings(spark, folder).select("id", is_local(locality, wanted).alias("is_local"))


CANDIDATES = """
candidate AS (
    SELECT id::VARCHAR AS city, pos, CASE WHEN pos = 0 THEN (CASE id % 4 WHEN 0 THEN id || 'x' WHEN 1 THEN 'other' WHEN 2 THEN '' ELSE left(id::VARCHAR, 1) END)
                                          WHEN id % 3 = 0 THEN id::VARCHAR ELSE 'far' END AS name,
           'http://sub' || id || '-' || pos || '.dir.example.ru' AS url
    FROM listings, (SELECT unnest([0, 1, 2]) AS pos)
),
ranked AS (
    SELECT *, CASE WHEN name = city THEN 0
                   WHEN pos = 0 AND (CASE WHEN length(city) >= 6 AND length(name) >= 6 THEN left(city, 6) = left(name, 6)
                                          ELSE starts_with(city, name) OR starts_with(name, city) END) THEN 1 END AS rank FROM candidate
),
best AS (SELECT city, name, url, pos FROM ranked WHERE rank IS NOT NULL QUALIFY row_number() OVER (PARTITION BY city ORDER BY rank, pos) = 1)
"""


def candidates(spark, folder):
    key = F.col("id")
    text = key.cast("string")
    first = F.when(key % 4 == 0, F.concat(text, F.lit("x"))).when(key % 4 == 1, "other").when(key % 4 == 2, "").otherwise(F.left(text, F.lit(1)))
    rows = listings(spark, folder).select("id", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("pos"))
    return rows.select(
        text.alias("city"),
        "pos",
        F.when(F.col("pos") == 0, first).when(key % 3 == 0, text).otherwise("far").alias("name"),
        F.lit(None).cast("string").alias("region"),
        F.concat(F.lit("http://sub"), text, F.lit("-"), F.col("pos").cast("string"), F.lit(".dir.example.ru")).alias("url"),
    )


@register("best_localities", listing_sql("SELECT city, name, url, pos FROM best", CANDIDATES))
def _(spark, folder):
    return best_localities(candidates(spark, folder)).select("city", "name", "url", "pos")


@register(
    "subdomains",
    listing_sql(
        """
SELECT id::VARCHAR AS city, CASE WHEN source = 'src0' THEN 'known' || id ELSE coalesce('sub' || id || '-' || (SELECT max(pos) FROM best b WHERE b.city = listings.id::VARCHAR), id::VARCHAR) END AS subdomain
FROM listings""",
        CANDIDATES,
    ),
)
def _(spark, folder):
    cities = listings(spark, folder).select(F.col("id").cast("string").alias("city"), "source")
    known = cities.where("source = 'src0'").select("city", F.concat(F.lit("known"), "city").alias("subdomain"))
    return resolve_subdomains(cities, known, best_localities(candidates(spark, folder)), "dir.example.ru")


@register(
    "directory_slugs",
    listing_sql("SELECT id, regexp_replace(lower(split_part(name, ' ', 1)) || '-' || (CASE WHEN id % 2 = 0 THEN 'novyy' ELSE 'russkiy' END), 'iy$', 'ij') AS subdomain FROM listings"),
)
def _(spark, folder):
    ending = F.when(F.col("id") % 2 == 0, "Новый").otherwise("Русский")
    return listings(spark, folder).select(
        "id", directory_subdomain(F.concat_ws(" ", F.substring_index("name", " ", 1), ending)).alias("subdomain")
    )


@register(
    "known_categories",
    listing_sql(
        """
SELECT id::VARCHAR AS city, 'shop' || id AS subdomain, 'https://shop' || id || '.example.ru/kontakty/' AS category_url, 'kontakty' AS category FROM listings WHERE id IN (SELECT DISTINCT id // 2 FROM listings)"""
    ),
)
def _(spark, folder):
    from rollcall.sources.derived_pages import shop_pages

    rows = listings(spark, folder)
    resolved = rows.select(F.col("id").cast("string").alias("city"), F.concat(F.lit("shop"), F.col("id").cast("string")).alias("subdomain"))
    return known_categories(resolved, shop_pages(rows), "example.ru", "kontakty")


@register(
    "cities_to_look_up",
    "SELECT DISTINCT n_name AS city FROM nation JOIN customer ON c_nationkey = n_nationkey WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal < 1000)",
)
def _(spark, folder):
    nations = nation_region(spark, folder)
    wanted = table(spark, folder, "customer").join(nations, F.col("c_nationkey") == F.col("n")).select(F.col("name").alias("city"))
    cached = table(spark, folder, "supplier").where("s_acctbal < 1000").join(nations, F.col("s_nationkey") == F.col("n"))
    return still_unknown(wanted, cached.select(F.col("name").alias("city")).distinct())


@register(
    "extended_cache",
    """
SELECT s_suppkey AS city, 'old' AS subdomain FROM supplier
UNION ALL SELECT c_custkey, 'new' FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)""",
)
def _(spark, folder):
    cache = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("city"), F.lit("old").alias("subdomain"))
    found = table(spark, folder, "customer").select(F.col("c_custkey").alias("city"), F.lit("new").alias("subdomain"))
    return extend_cache(cache, found)


@register(
    "listing_urls",
    listing_sql(
        """
SELECT city, url FROM (
    SELECT DISTINCT city, CASE WHEN region = 'ASIA' THEN 'https://dir.example.ru/' || lower(replace(city, '_', '')) || '/works/' ELSE 'https://dir.example.ru/c/' || (id % 3) END AS url
    FROM listings)"""
    ),
)
def _(spark, folder):
    rows = listings(spark, folder)
    paths = rows.where("region <> 'ASIA'").select("city", F.concat(F.lit("/c/"), (F.col("id") % 3).cast("string"), F.lit("/")).alias("path")).distinct()
    return listing_urls(rows, "https://dir.example.ru", "/{city}/works/", paths)


@register(
    "search_urls",
    listing_sql("SELECT DISTINCT city, 'https://map.example.ru/' || lower(replace(city, '_', '')) || '/search/stone%20works' AS url FROM listings"),
)
def _(spark, folder):
    return search_urls(listings(spark, folder), "https://map.example.ru", "stone works")


@register(
    "active_sources",
    "SELECT source, count(*) AS documents FROM documents WHERE CASE WHEN source = 'src3' THEN false ELSE true END GROUP BY source",
)
def _(spark, folder):
    documents = table(spark, folder, "documents")
    enabled = F.when(F.col("source") == "src3", False).when(F.col("source") == "src5", True)
    return active_sources(documents.withColumn("enabled", enabled)).groupBy("source").agg(F.count(F.lit(1)).alias("documents"))


@register(
    "stage_by_city",
    listing_sql(
        """
, c AS (SELECT city, count(*) FILTER (region <> 'ASIA') AS n_raw, count(*) FILTER (region IN ('AFRICA', 'AMERICA')) AS n_companies,
              count(*) FILTER (region = 'AFRICA' AND website IS NOT NULL) AS n_enriched FROM listings GROUP BY city)
SELECT city, CASE WHEN n_enriched > 0 THEN 'enriched' WHEN n_companies > 0 THEN 'deduped' WHEN n_raw > 0 THEN 'scraped' ELSE 'start' END AS stage,
       n_raw, n_companies, n_enriched FROM c"""
    ),
)
def _(spark, folder):
    rows = listings(spark, folder)
    return stage_by_city(
        rows.select("city"),
        rows.where("region <> 'ASIA'"),
        rows.where("region in ('AFRICA', 'AMERICA')"),
        rows.where("region = 'AFRICA' and website is not null"),
    )


@register(
    "collection_counts",
    listing_sql("SELECT city, source, count(*) AS listings FROM listings GROUP BY ROLLUP (city, source)"),
)
def _(spark, folder):
    return collection_counts(listings(spark, folder))
