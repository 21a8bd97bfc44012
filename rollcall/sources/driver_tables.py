"""Listings and search results derived from the customer, nation and region tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.schema import GEO

STREETS = ("Sadovaya", "Lesnaya", "Polevaya", "Rechnaya", "Zelenaya", "Dachnaya", "Novaya")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


_STREETS = ", ".join(f"'{name}'" for name in STREETS)


def _links(**links: str) -> str:
    """SQL of a map with the links that are not null."""
    entries = ", ".join(f"struct('{kind}' AS key, {link} AS value)" for kind, link in links.items())
    return f"map_from_entries(filter(array({entries}), e -> e.value IS NOT NULL))"


def shape_listings(customers: DataFrame, nations: DataFrame, regions: DataFrame) -> DataFrame:
    """One listing per customer; every column is plain arithmetic on the key and the nation."""
    base = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).join(
        regions, F.col("n_regionkey") == F.col("r_regionkey")
    )
    numbered = base.selectExpr(
        "c_custkey AS k",
        "CAST(c_nationkey AS BIGINT) AS n",
        "n_name",
        "r_name",
        "CAST(9000000000 + c_nationkey * 100000L + c_custkey div 60 AS STRING) AS number",
        "CAST(9000000000 + c_nationkey * 100000L + (c_custkey + 30) div 60 AS STRING) AS bridge",
        "concat(c_mktsegment, ' workshop ', c_custkey div 60) AS title",
    )
    return numbered.selectExpr(
        "k AS id",
        "concat('src', k % 5) AS source",
        "concat('https://listing.example.ru/', n, '/', k div 2) AS source_url",
        "CASE WHEN k % 3 = 1 THEN concat(title, ' LLC') WHEN k % 4 = 2 THEN upper(title) ELSE title END AS name",
        """array_compact(array(
            CASE k % 4 WHEN 1 THEN concat('+7 (', substr(number, 1, 3), ') ', substr(number, 4, 3), '-',
                                          substr(number, 7, 2), '-', substr(number, 9, 2))
                       WHEN 2 THEN concat('8', number) WHEN 3 THEN number END,
            CASE WHEN k % 5 = 0 THEN concat('7', bridge) END,
            CASE WHEN k % 17 = 0 THEN '12345' END)) AS phones""",
        f"concat('г. ', n_name, ', ул. ', element_at(array({_STREETS}), CAST(k % 7 + 1 AS INT)), ', ', k % 50) AS address_raw",
        """CASE WHEN k % 3 = 0 THEN concat(IF(k % 9 = 0, '', 'https://'), IF(k % 2 = 0, 'www.', ''), 'site', n, '-', k div 90,
                                           '.example.ru', IF(k % 6 = 0, '/contacts', '')) END AS website""",
        """array_compact(array(CASE WHEN k % 2 = 0 THEN concat('info', k div 60, '@site', n, '.example.ru') END,
                               CASE WHEN k % 22 = 0 THEN 'notanemail' END)) AS emails""",
        f"CAST(NULL AS {GEO.simpleString()}) AS geo",
        _links(
            telegram="CASE WHEN k % 3 = 1 THEN concat('https://t.me/shop', k) END",
            whatsapp="CASE WHEN k % 4 = 2 THEN concat('https://wa.me/7', number) END",
            vk="CASE WHEN k % 5 = 3 THEN concat('https://vk.com/shop', k) END",
        )
        + " AS messengers",
        "n_name AS city",
        "r_name AS region",
        "element_at(array('unknown', 'bitrix', 'wordpress', 'tilda', 'flexbe', 'joomla'), CAST(k % 6 + 1 AS INT)) AS cms",
        "k % 9 = 0 AS has_marquiz",
        "CAST(k % 4 - 1 AS INT) AS trust_score",
        "number",
    )


def dealt(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` over all cores by their key: a small file is read by a task or two, and what is derived from its rows costs far more."""
    return rows.repartition(2 * rows.sparkSession.sparkContext.defaultParallelism, key)


def listings(spark: SparkSession, folder: str) -> DataFrame:
    return shape_listings(table(spark, folder, "customer"), table(spark, folder, "nation"), table(spark, folder, "region"))


def dealt_listings(spark: SparkSession, folder: str) -> DataFrame:
    """``listings`` for work that costs much per row before its first shuffle, such as reading answers and page texts."""
    return shape_listings(dealt(table(spark, folder, "customer"), "c_custkey"), table(spark, folder, "nation"), table(spark, folder, "region"))


def shape_sites(rows: DataFrame) -> DataFrame:
    """What a visit to the found site of a listing returns."""
    return rows.where("id % 3 <> 0 OR id % 2 = 1").selectExpr(
        "id",
        "concat('https://found', id, '.example.ru') AS website",
        "array(concat('found', id, '@example.ru')) AS emails",
        "array_append(slice(phones, 1, 1), concat('+7 (955) ', lpad(CAST(id % 10000000 AS STRING), 7, '0'))) AS phones",
        _links(
            telegram="CASE WHEN id % 2 = 0 THEN concat('https://t.me/found', id) END",
            vk="CASE WHEN id % 7 = 0 THEN concat('https://vk.com/found', id) END",
        )
        + " AS messengers",
        "IF(id % 3 = 1, 'tilda', 'unknown') AS cms",
    )


def sites(spark: SparkSession, folder: str) -> DataFrame:
    return shape_sites(listings(spark, folder))


def enriched_listings(spark: SparkSession, folder: str) -> DataFrame:
    """Listings in the shape of enriched companies, phones and e-mails cleaned."""
    from rollcall.functions.emails import valid_emails
    from rollcall.functions.phones import normalize_phones

    return listings(spark, folder).select(
        "id",
        "name",
        normalize_phones(F.col("phones")).alias("phones"),
        "address_raw",
        "website",
        valid_emails(F.col("emails")).alias("emails"),
        "city",
        "region",
        "messengers",
        F.struct(F.col("trust_score")).alias("tg_trust"),
        "cms",
        "has_marquiz",
        F.lit(False).alias("is_network"),
    )
