"""How far each city has come, and what was collected for it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stage_by_city(cities: DataFrame, raw: DataFrame, companies: DataFrame, enriched: DataFrame) -> DataFrame:
    """(city, stage, n_raw, n_companies, n_enriched): enriched, deduped, scraped or start, for all cities at once."""
    tables = {"n_raw": raw, "n_companies": companies, "n_enriched": enriched}
    counts = [df.groupBy("city").agg(F.count(F.lit(1)).alias(name)) for name, df in tables.items()]
    joined = reduce(lambda a, b: a.join(b, "city", "left"), counts, cities.select("city").distinct())
    filled = joined.na.fill(0, list(tables))
    stage = (
        F.when(F.col("n_enriched") > 0, "enriched")
        .when(F.col("n_companies") > 0, "deduped")
        .when(F.col("n_raw") > 0, "scraped")
        .otherwise("start")
    )
    return filled.select("city", stage.alias("stage"), *tables)


def collection_counts(listings: DataFrame) -> DataFrame:
    """Listings per city and source, with the city total and the grand total as rows without a source or city."""
    return listings.rollup("city", "source").agg(F.count(F.lit(1)).alias("listings"))


def collection_gaps(listings: DataFrame, declared: DataFrame) -> DataFrame:
    """(category, collected, declared, missing) from the totals directory pages state.

    ``declared`` is (category, page, total); the total of the first page that states one counts.
    """
    from rollcall.operators.picking import first_per_key

    totals = first_per_key(declared.where("total is not null"), ["category"], "page").select(
        "category", F.col("total").alias("declared")
    )
    collected = listings.groupBy("category").agg(F.count(F.lit(1)).alias("collected"))
    joined = totals.join(collected, "category", "full").select(
        "category", F.coalesce("collected", F.lit(0)).alias("collected"), "declared"
    )
    return joined.withColumn("missing", F.greatest(F.col("declared") - F.col("collected"), F.lit(0)))
