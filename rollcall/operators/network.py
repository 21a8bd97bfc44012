"""Branch networks: companies of a scope that share a website host or a phone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.binding import rows_with
from rollcall.functions.phones import normalize_phone
from rollcall.functions.urls import domain_of
from rollcall.operators.linkage import SCOPE
from rollcall.settings import NETWORK_SIZE


def domain_counts(companies: DataFrame, scope: tuple[str, ...] = SCOPE, threshold: int = NETWORK_SIZE) -> DataFrame:
    keyed = companies.select(*scope, rows_with(domain_of(F.col("website"))).alias("domain"))
    return keyed.groupBy(*scope, "domain").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= threshold)


def phone_rows(companies: DataFrame, scope: tuple[str, ...] = SCOPE) -> DataFrame:
    """(scope, id, phone) per listed phone, normalised, repeats of one company included."""
    numbers = F.array_compact(F.transform("phones", lambda p: normalize_phone(p)))
    return companies.select(*scope, "id", F.explode(numbers).alias("phone"))


def phone_counts(
    companies: DataFrame, scope: tuple[str, ...] = SCOPE, threshold: int = NETWORK_SIZE, occurrences: bool = False
) -> DataFrame:
    """Phones of ``threshold`` and more companies. ``occurrences`` counts listings of a number instead."""
    rows = phone_rows(companies, scope)
    counted = rows if occurrences else rows.distinct()
    return (
        counted.groupBy(*scope, "phone").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= threshold)
    )


def network_ids(links: DataFrame, scope: tuple[str, ...] = SCOPE, threshold: int = NETWORK_SIZE) -> DataFrame:
    """Ids holding a key that ``threshold`` ids of the scope hold, from (scope, key, id) links.

    Counts are pre-aggregated and joined back, one row per frequent key, so a hot key
    is neither collected nor sorted in one task.
    """
    keys = [*scope, "key"]
    frequent = links.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= threshold).select(*keys)
    return links.join(frequent, keys, "left_semi").select("id").distinct()


def flag_networks(
    companies: DataFrame,
    scope: tuple[str, ...] = SCOPE,
    threshold: int = NETWORK_SIZE,
    phones: DataFrame | None = None,
    occurrences: bool = False,
) -> DataFrame:
    """Sets ``is_network`` afresh on every company. An empty ``scope`` looks across all of them.

    ``phones`` gives (scope, id, phone) rows for companies whose phones are kept in a long table.
    """
    listed = phone_rows(companies, scope) if phones is None else phones.select(*scope, "id", "phone")
    by_phone = (listed if occurrences else listed.distinct()).select(
        *scope, F.concat(F.lit("p:"), "phone").alias("key"), "id"
    )
    host = rows_with(F.concat(F.lit("s:"), domain_of(F.col("website"))))
    by_domain = companies.select(*scope, host.alias("key"), "id")
    flagged = network_ids(by_domain.unionByName(by_phone), scope, threshold).withColumn("flag", F.lit(True))
    return (
        companies.drop("is_network")
        .join(flagged, "id", "left")
        .withColumn("is_network", F.coalesce("flag", F.lit(False)))
        .drop("flag")
    )
