"""SQL of the derived views, in the dialect of the check tool, and small helpers of the queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.texts import BLANKS
from rollcall.sources.driver_tables import STREETS

STREET_LIST = ", ".join(f"'{name}'" for name in STREETS)

BLANK_SQL = " || ".join(f"chr({ord(ch)})" for ch in BLANKS)

LISTINGS = f"""
base AS (
    SELECT c_custkey AS k, c_nationkey AS n, n_name, r_name,
           (9000000000 + c_nationkey * 100000 + c_custkey // 60)::VARCHAR AS num,
           (9000000000 + c_nationkey * 100000 + (c_custkey + 30) // 60)::VARCHAR AS bridge,
           c_mktsegment || ' workshop ' || (c_custkey // 60) AS nm
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
listings AS (
    SELECT k AS id, 'src' || (k % 5) AS source,
           'https://listing.example.ru/' || n || '/' || (k // 2) AS source_url,
           CASE WHEN k % 3 = 1 THEN nm || ' LLC' WHEN k % 4 = 2 THEN upper(nm) ELSE nm END AS name,
           list_filter([
               CASE k % 4 WHEN 1 THEN '+7 (' || substr(num, 1, 3) || ') ' || substr(num, 4, 3) || '-'
                                      || substr(num, 7, 2) || '-' || substr(num, 9, 2)
                          WHEN 2 THEN '8' || num WHEN 3 THEN num END,
               CASE WHEN k % 5 = 0 THEN '7' || bridge END,
               CASE WHEN k % 17 = 0 THEN '12345' END], lambda x: x IS NOT NULL) AS phones,
           'г. ' || n_name || ', ул. ' || ([{STREET_LIST}])[(k % 7) + 1] || ', ' || (k % 50) AS address_raw,
           CASE WHEN k % 3 = 0 THEN (CASE WHEN k % 9 = 0 THEN '' ELSE 'https://' END)
               || (CASE WHEN k % 2 = 0 THEN 'www.' ELSE '' END) || 'site' || n || '-' || (k // 90) || '.example.ru'
               || (CASE WHEN k % 6 = 0 THEN '/contacts' ELSE '' END) END AS website,
           list_filter([
               CASE WHEN k % 2 = 0 THEN 'info' || (k // 60) || '@site' || n || '.example.ru' END,
               CASE WHEN k % 22 = 0 THEN 'notanemail' END], lambda x: x IS NOT NULL) AS emails,
           CASE WHEN k % 3 = 1 THEN 'https://t.me/shop' || k END AS telegram,
           CASE WHEN k % 4 = 2 THEN 'https://wa.me/7' || num END AS whatsapp,
           CASE WHEN k % 5 = 3 THEN 'https://vk.com/shop' || k END AS vk,
           n_name AS city, r_name AS region,
           (['unknown', 'bitrix', 'wordpress', 'tilda', 'flexbe', 'joomla'])[(k % 6) + 1] AS cms,
           k % 9 = 0 AS has_marquiz, (k % 4) - 1 AS trust_score, num AS number
    FROM base
),
raw_phones AS (
    SELECT id, city, generate_subscripts(phones, 1) AS pos, regexp_replace(unnest(phones), '[^0-9]', '', 'g') AS d
    FROM listings
),
phone_values AS (
    SELECT id, city, pos,
           CASE WHEN length(d) = 11 AND d[1] = '8' THEN '7' || substr(d, 2) WHEN length(d) = 10 THEN '7' || d ELSE d END AS p
    FROM raw_phones
),
phone AS (
    SELECT id, city, p AS phone, min(pos) AS pos FROM phone_values WHERE length(p) = 11 AND p[1] = '7' GROUP BY ALL
),
email_values AS (SELECT id, city, generate_subscripts(emails, 1) AS pos, unnest(emails) AS e FROM listings),
email AS (
    SELECT id, city, e AS email, min(pos) AS pos FROM email_values
    WHERE regexp_matches(e, '^[a-zA-Z0-9._%+\\-]+@[a-zA-Z0-9.\\-]+\\.[a-zA-Z]{{2,}}$') GROUP BY ALL
),
domain AS (
    SELECT id, city, regexp_replace(lower(regexp_extract(
               CASE WHEN contains(website, '://') THEN website ELSE 'https://' || website END,
               '^[^:/?#]+://([^/?#]*)', 1)), '^www\\.', '') AS domain
    FROM listings WHERE website IS NOT NULL
)
"""

# Lowest listing id that each listing hangs together with by shared keys.
COMPONENTS = """
link AS (SELECT city, 'p:' || phone AS key, id FROM phone UNION ALL SELECT city, 's:' || domain, id FROM domain),
centre AS (SELECT city, key, min(id) AS lo FROM link GROUP BY ALL),
star AS (SELECT DISTINCT id AS hi, lo FROM link JOIN centre USING (city, key) WHERE id > lo),
edge AS (SELECT hi AS a, lo AS b FROM star UNION SELECT lo, hi FROM star),
reach AS (SELECT id, id AS other FROM listings UNION SELECT r.id, e.b FROM reach r JOIN edge e ON r.other = e.a),
component AS (SELECT id, min(other) AS entity FROM reach GROUP BY id)
"""


def listing_sql(select: str, *more: str) -> str:
    """A statement over ``listings`` and the views derived from it."""
    return "WITH RECURSIVE " + ",".join([LISTINGS, *more]) + select


def joined(values: str | Column) -> Column:
    return F.array_join(values, ";")


def messenger_text(column: str = "messengers") -> Column:
    """A messenger map as sorted text."""
    entries = F.array_sort(F.map_entries(F.col(column)))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")


def with_joined_lists(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: joined(F.col(c)) for c in columns})
