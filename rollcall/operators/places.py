"""Region and city dimensions, locality lookup and the addresses to collect next.

The dimensions are joined without hints: Spark broadcasts a side only when its size
on disk or after a finished stage is below ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rollcall.functions.places import name_rank
from rollcall.functions.texts import directory_subdomain, slugify
from rollcall.operators.picking import first_per_key
from rollcall.settings import DIRECTORY_CATEGORY, STANDARD_SOURCES, SUBDOMAINS


def region_cities(wanted: DataFrame, cities: DataFrame, region_city: DataFrame) -> DataFrame:
    """(city, town): all towns of the region of each wanted city.

    Towns come from ``region_city`` (region, town), else from the ``cities`` (name, region) of the same region,
    else the city stands alone.
    """
    own = wanted.select("city").distinct().join(
        first_per_key(cities.where("name is not null"), ["name"], F.coalesce("region", F.lit(""))).select(
            F.col("name").alias("city"), F.nullif("region", F.lit("")).alias("region")
        ),
        "city",
        "left",
    )
    listed = region_city.select("region", F.col("town").alias("listed")).distinct()
    siblings = cities.select("region", F.col("name").alias("sibling")).distinct()
    covered = own.join(listed, "region", "left")
    open_cities = covered.where("listed is null").drop("listed")
    return (
        covered.where("listed is not null")
        .select("city", F.col("listed").alias("town"))
        .unionByName(
            open_cities.join(siblings, "region", "left").select("city", F.coalesce("sibling", "city").alias("town"))
        )
    )


#: Ids of collected listings are below this.
COPY_IDS = 1 << 50


def relabel_scope(listings: DataFrame, town_city: DataFrame) -> DataFrame:
    """Puts every listing of a town under the city it was collected for; other towns stay.

    A town of several wanted cities gives a listing for each. The first city by name keeps the id, the n-th one gets
    ids n * 2^50 higher, so that no id stands for two listings.
    """
    pairs = town_city.select("town", F.col("city").alias("scope_city")).distinct()
    turns = pairs.withColumn("turn", F.row_number().over(Window.partitionBy("town").orderBy("scope_city")) - 1)
    joined = listings.join(turns.withColumnRenamed("town", "city"), "city", "left")
    changed = {"city": F.coalesce("scope_city", "city"), "id": F.col("id") + F.coalesce("turn", F.lit(0)) * F.lit(COPY_IDS)}
    return joined.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in listings.columns])


def region_totals(region_city: DataFrame) -> DataFrame:
    return region_city.agg(F.countDistinct("region").alias("regions"), F.count(F.lit(1)).alias("towns"))


def active_sources(sources: DataFrame) -> DataFrame:
    """Sources that are switched on; a missing flag means on."""
    return sources.where(F.coalesce("enabled", F.lit(True)))


def standard_active_sources(flags: dict[str, dict], names: tuple[str, ...] = STANDARD_SOURCES) -> list[str]:
    return [name for name in names if flags.get(name, {}).get("enabled", True)]


def best_localities(candidates: DataFrame) -> DataFrame:
    """Per queried city the matching candidate: the exact name, else a similar first one.

    ``candidates`` holds (city, pos, name, region, url), ``pos`` from 0.
    """
    ranked = candidates.withColumn("rank", name_rank(F.col("name"), F.col("pos"), F.col("city"))).where("rank is not null")
    return first_per_key(ranked, ["city"], "rank", "pos").drop("rank")


def subdomain_in(url: Column, site: str) -> Column:
    """First label of a host below ``site``: ``http://kazan.site.ru`` gives ``kazan``."""
    pattern = rf"^https?://([a-z0-9-]+)\.{site.replace('.', '[.]')}"
    return F.nullif(F.regexp_extract(url, pattern, 1), F.lit(""))


def resolve_subdomains(cities: DataFrame, known: DataFrame, found: DataFrame, site: str, manual: dict[str, str] = SUBDOMAINS) -> DataFrame:
    """(city, subdomain): the stored or manual one, else the one looked up, else the slug of the city.

    ``known`` is (city, subdomain), ``found`` the result of ``best_localities``, ``manual`` goes by lower-case names.
    """
    by_hand = F.create_map(*[F.lit(x) for pair in manual.items() for x in pair]) if manual else F.create_map().cast("map<string,string>")
    stored = known.select("city", F.col("subdomain").alias("stored"))
    looked_up = found.select("city", subdomain_in(F.col("url"), site).alias("looked_up"))
    joined = cities.select("city").distinct().join(stored, "city", "left").join(looked_up, "city", "left")
    return joined.select("city", F.coalesce("stored", F.try_element_at(by_hand, F.lower("city")), "looked_up", directory_subdomain(F.col("city"))).alias("subdomain"))


def known_categories(resolved: DataFrame, pages: DataFrame, site: str, category: str = DIRECTORY_CATEGORY) -> DataFrame:
    """Keeps the cities whose category page is stored with status 200."""
    url = F.concat(F.lit("https://"), "subdomain", F.lit(f".{site}/{category}/"))
    reached = pages.where("status = 200").select(F.col("url").alias("category_url"))
    return (
        resolved.withColumn("category_url", url).join(reached, "category_url", "left_semi").withColumn("category", F.lit(category))
    )


def still_unknown(cities: DataFrame, cache: DataFrame) -> DataFrame:
    """Cities that need a lookup because the cache does not hold them."""
    return cities.select("city").distinct().join(cache.select("city"), "city", "left_anti")


def extend_cache(cache: DataFrame, discovered: DataFrame) -> DataFrame:
    """The cache plus the discovered rows for cities it did not hold."""
    fresh = discovered.join(cache.select("city"), "city", "left_anti")
    return cache.unionByName(fresh.select(*cache.columns))


def listing_urls(cities: DataFrame, site: str, base_path: str, categories: DataFrame | None = None) -> DataFrame:
    """(city, url) to collect: one per category path of a city, else the base path with the city's slug.

    ``base_path`` holds ``{city}`` where the slug goes. ``categories`` is (city, path).
    """
    wanted = cities.select("city").distinct()
    slug = slugify(F.col("city"))
    head, _, tail = base_path.partition("{city}")
    fallback = F.concat(F.lit(site + head), slug, F.lit(tail)) if "{city}" in base_path else F.lit(site + base_path)
    if categories is None:
        return wanted.select("city", fallback.alias("url"))
    listed = F.concat(F.lit(site), F.rtrim("path", F.lit("/")))
    return wanted.join(categories.select("city", "path"), "city", "left").select(
        "city", F.when(F.col("path").isNotNull(), listed).otherwise(fallback).alias("url")
    )


def search_urls(cities: DataFrame, site: str, phrase: str) -> DataFrame:
    """(city, url) of a directory search for a phrase in each city."""
    path = F.concat(F.lit(site + "/"), slugify(F.col("city")), F.lit("/search/"), F.replace(F.url_encode(F.lit(phrase)), F.lit("+"), F.lit("%20")))
    return cities.select("city").distinct().select("city", path.alias("url"))
