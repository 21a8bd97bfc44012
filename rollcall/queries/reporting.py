"""Export rows, report lines, snapshots and the whole run."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.plans.full_run import Rules, publish, refill, run
from rollcall.queries import register
from rollcall.queries.base import COMPONENTS, listing_sql, with_joined_lists
from rollcall.queries.enriching import FILL, SCANNED, SHOPS
from rollcall.queries.grouping import MERGED
from rollcall.queries.scoring import NETWORK, SCORED, scored_listings
from rollcall.scratch import scratch_path
from rollcall.sinks.reports import csv_rows, markdown_lines, read_csv
from rollcall.sinks.tables import ScopedTable, Snapshots, upsert, without_scopes
from rollcall.sources import derived_pages
from rollcall.sources.driver_tables import dealt_listings, enriched_listings, listings, sites
from rollcall.sources.search import search_results


@register(
    "csv_rows",
    listing_sql(
        """
SELECT city, id, name, replace(phone_text, ';', '; ') AS phones, address_raw AS address, coalesce(website, '') AS website,
       replace(email_text, ';', '; ') AS emails, segment, crm_score, CASE WHEN is_network THEN 'Yes' ELSE 'No' END AS is_network, cms,
       CASE WHEN has_marquiz THEN 'Yes' ELSE 'No' END AS has_marquiz, coalesce(telegram, '') AS telegram, coalesce(vk, '') AS vk,
       coalesce(whatsapp, '') AS whatsapp FROM scored""",
        NETWORK,
        SCORED,
    ),
)
def _(spark, folder):
    return csv_rows(scored_listings(spark, folder))


MARKDOWN = r"""
line AS (
    SELECT city, 0 AS section, -1099511627776 AS rank, unnest(range(0, 6)) AS id,
           unnest(['# База мастерских: ' || upper(city[1]) || lower(substr(city, 2)) || ' — all', '', '**Фильтр:** every company', '',
                   '**Всего компаний:** ' || count(*), '']) AS line
    FROM scored GROUP BY city
    UNION ALL
    SELECT city, ascii(segment) - 64, -1099511627776, unnest(range(0, 4)),
           unnest(['## Сегмент ' || segment || ' (' || count(*) || ' шт.)', '', '| Название | Телефон | Сайт | Telegram | CMS | Score |',
                   '|----------|---------|------|----------|-----|-------|'])
    FROM scored GROUP BY city, segment
    UNION ALL SELECT DISTINCT city, ascii(segment) - 64, 1099511627776, 0, '' FROM scored
    UNION ALL
    SELECT city, ascii(segment) - 64, -crm_score, id,
           '| **' || name || '** | ' || replace(phone_text, ';', '<br>') || ' | ' || CASE WHEN website IS NULL THEN '-' ELSE '[Сайт](' || website || ')' END
           || ' | ' || CASE WHEN telegram IS NULL THEN '-' ELSE '[TG](' || telegram || ')' END || ' | ' || cms || ' | ' || crm_score || ' |'
    FROM scored
)
SELECT city, section, rank, id, line FROM line"""


@register("markdown_lines", listing_sql("", NETWORK, SCORED, MARKDOWN))
def _(spark, folder):
    return markdown_lines(scored_listings(spark, folder), preset="all", description="every company")


@register(
    "exported_files",
    listing_sql(
        """
SELECT 'enriched' AS export, city, id::VARCHAR AS entry FROM scored
UNION ALL SELECT 'hot_leads', city, id::VARCHAR FROM scored WHERE telegram IS NOT NULL AND crm_score >= 50
UNION ALL SELECT 'high_score', city, id::VARCHAR FROM scored WHERE segment = 'A'
UNION ALL SELECT 'with_telegram', city, id::VARCHAR FROM scored WHERE telegram IS NOT NULL
UNION ALL SELECT 'cold_email', city, id::VARCHAR FROM scored WHERE telegram IS NULL AND whatsapp IS NULL AND n_emails > 0
UNION ALL SELECT 'manual_search', city, name FROM scored WHERE telegram IS NULL AND whatsapp IS NULL
UNION ALL SELECT 'full_dump', city, id::VARCHAR FROM scored""",
        NETWORK,
        SCORED,
    ),
)
def _(spark, folder):
    """Writes every export and reads the companies of each city back from the files."""
    target = scratch_path(spark, "export")
    entries = []
    for name, path in publish(scored_listings(spark, folder), target).items():
        if name == "manual_search":
            rows = spark.read.text(path).where("value like '| **%'")
            found = rows.select("city", F.regexp_extract("value", r"^\| \*\*(.*?)\*\* \|", 1).alias("entry"))
        elif name == "full_dump":
            found = spark.read.schema("id string, city string").json(path).select("city", F.col("id").alias("entry"))
        else:
            found = read_csv(spark, path).select("city", F.col("id").alias("entry"))
        entries.append(found.select(F.lit(name).alias("export"), "city", "entry"))
    return reduce(DataFrame.unionByName, entries)


@register(
    "upserted_snapshot",
    listing_sql(
        """
SELECT coalesce(a.id, b.id) AS id, coalesce(b.city, a.city) AS city, coalesce(b.website, a.website) AS website, coalesce(b.cms, a.cms) AS cms
FROM (SELECT id, city, website, cms FROM listings WHERE cms <> 'tilda') a
FULL JOIN (SELECT id, city, CASE WHEN id % 2 = 0 THEN 'https://new' || id END AS website, 'new' AS cms FROM listings WHERE cms <> 'bitrix') b ON a.id = b.id"""
    ),
)
def _(spark, folder):
    rows = listings(spark, folder).select("id", "city", "website", "cms")
    changes = rows.where("cms <> 'bitrix'").select(
        "id", "city", F.when(F.col("id") % 2 == 0, F.concat(F.lit("https://new"), F.col("id").cast("string"))).alias("website"), F.lit("new").alias("cms")
    )
    return upsert(rows.where("cms <> 'tilda'"), changes)


@register(
    "stored_snapshots",
    listing_sql("SELECT id, city, CASE WHEN website IS NOT NULL THEN 'second' ELSE 'first' END AS status FROM listings WHERE city <> 'NATION_3'"),
)
def _(spark, folder):
    """Three versions of a table: written, upserted, one city deleted."""
    shops = listings(spark, folder)
    rows = shops.select("id", "city", F.lit("first").alias("status"))
    snapshots = Snapshots(spark, scratch_path(spark, "snapshots"))
    snapshots.upsert(rows)
    snapshots.upsert(shops.where("website is not null").select("id", "city", F.lit("second").alias("status")))
    return snapshots.delete_scopes(["NATION_3"]).select("id", "city", "status")


@register(
    "upserted_cities",
    listing_sql(
        "SELECT id, city, CASE WHEN region = 'ASIA' AND website IS NOT NULL THEN 'second' ELSE 'first' END AS status FROM listings WHERE city <> 'NATION_3'"
    ),
)
def _(spark, folder):
    """A table kept by city: appended, one region upserted in place, one city deleted."""
    shops = listings(spark, folder)
    stored = ScopedTable(spark, scratch_path(spark, "cities"))
    stored.append(shops.select("id", "city", F.lit("first").alias("status")))
    stored.upsert(shops.where("region = 'ASIA' and website is not null").select("id", "city", F.lit("second").alias("status")))
    stored.delete_scopes(["NATION_3"])
    return stored.read().select("id", "city", "status")


@register("without_scopes", listing_sql("SELECT id, city FROM listings WHERE city NOT IN ('NATION_1', 'NATION_2')"))
def _(spark, folder):
    return without_scopes(listings(spark, folder).select("id", "city"), ["NATION_1", "NATION_2"])


REFILLED = """
value AS (SELECT id, city, kind, e.value, late, pos FROM every e JOIN listings USING (id)),
site AS (SELECT id, city, CASE WHEN site_new THEN 'found' || id || '.example.ru' ELSE (SELECT max(domain) FROM domain d WHERE d.id = done.id) END AS host FROM done),
shared AS (
    SELECT id FROM value SEMI JOIN (SELECT city, value FROM value WHERE kind = 'phone' GROUP BY ALL HAVING count(DISTINCT id) > 1) USING (city, value) WHERE kind = 'phone'
    UNION SELECT id FROM site SEMI JOIN (SELECT city, host FROM site WHERE host IS NOT NULL GROUP BY ALL HAVING count(*) > 1) USING (city, host)
),
sized AS (
    SELECT d.id, d.city, (SELECT count(*) FROM every e WHERE e.id = d.id AND kind = 'phone') AS n_phones,
           (SELECT count(*) FROM every e WHERE e.id = d.id AND kind = 'email') AS n_emails, trust_score, l.has_marquiz,
           site_new OR old_site IS NOT NULL AS has_site, tg_new OR old_tg IS NOT NULL AS has_tg, d.whatsapp IS NOT NULL AS has_wa,
           CASE WHEN cms_new THEN 'tilda' ELSE old_cms END AS builder
    FROM done d JOIN listings l USING (id)
),
rescored AS (
    SELECT id, city, n_phones::INTEGER AS n_phones, n_emails::INTEGER AS n_emails, id IN (SELECT id FROM shared) AS is_network,
           (CASE WHEN has_site THEN 5 + (CASE WHEN builder = 'bitrix' THEN 10 WHEN builder IN ('wordpress', 'tilda', 'flexbe') THEN 3 ELSE 0 END)
                 + (CASE WHEN has_marquiz THEN 8 ELSE 0 END) ELSE 0 END + CASE WHEN has_tg THEN 15 + 2 * trust_score ELSE 0 END
            + CASE WHEN has_wa THEN 10 ELSE 0 END + CASE WHEN n_phones > 1 THEN 5 ELSE 0 END + CASE WHEN n_emails > 0 THEN 5 ELSE 0 END
            + CASE WHEN id IN (SELECT id FROM shared) THEN 5 ELSE 0 END)::INTEGER AS crm_score
    FROM sized
)
"""


@register(
    "refilled_companies",
    listing_sql(
        "SELECT *, CASE WHEN crm_score >= 50 THEN 'A' WHEN crm_score >= 30 THEN 'B' WHEN crm_score >= 15 THEN 'C' ELSE 'D' END AS segment FROM rescored",
        FILL,
        REFILLED,
    ),
)
def _(spark, folder):
    """Enriched companies whose gaps are filled from their found site, flagged and scored again."""
    rows = enriched_listings(spark, folder)
    found = sites(spark, folder)
    hits = found.select("id", F.lit(0).alias("pos"), F.col("website").alias("url"), F.lit("").alias("title"))
    details = found.drop("id").withColumnRenamed("website", "url")
    again = details.withColumn("emails", F.array().cast("array<string>"))
    return refill(rows, hits, details.unionByName(again)).scored.select("id", "city", "n_phones", "n_emails", "is_network", "crm_score", "segment")


WHOLE_RUN = r"""
visited AS (
    SELECT *, CASE WHEN website IS NULL OR starts_with(website, 'http') THEN website ELSE 'https://' || website END AS clean FROM company
),
keyed AS (SELECT *, try_cast(regexp_extract(clean, '^https://shop([0-9]+)\.example\.ru/$', 1) AS BIGINT) AS shop FROM visited),
seen AS (
    SELECT k.id, k.city, name_best, clean, phones, emails, merged_from, n_emails, needs_review, coalesce(k.telegram, f.telegram) AS tg,
           coalesce(k.vk, f.vk) AS vk, coalesce(k.whatsapp, f.whatsapp) AS wa, coalesce(f.cms, 'unknown') AS cms,
           coalesce(f.has_marquiz, false) AS quiz
    FROM keyed k LEFT JOIN scanned f ON f.s = k.shop
),
trusted AS (
    SELECT *, (p % 2 = 0)::INTEGER + (p % 3 = 0)::INTEGER - (p % 5 = 0)::INTEGER - (p % 7 = 0)::INTEGER AS trust
    FROM (SELECT *, (SELECT max(l.id) FROM listings l WHERE 'https://t.me/shop' || l.id = tg) AS p FROM seen)
),
answered AS (SELECT city, name, min(id) AS m FROM listings WHERE id % 8 NOT IN (0, 1) GROUP BY ALL),
chosen AS (
    SELECT t.id, m FROM trusted t JOIN answered a ON a.city = t.city AND a.name = t.name_best
    WHERE (clean IS NULL OR n_emails = 0) AND m % 3 = 0 AND m % 2 = 1 AND m % 11 <> 0
),
offered AS (
    SELECT c.id, 'phone' AS kind, 0 AS pos, p AS value FROM chosen c JOIN phone_values v ON v.id = m AND v.pos = 1 WHERE length(p) = 11 AND p[1] = '7'
    UNION ALL SELECT id, 'phone', 1, '7955' || lpad((m % 10000000)::VARCHAR, 7, '0') FROM chosen
    UNION ALL SELECT id, 'email', 0, 'found' || m || '@example.ru' FROM chosen
),
had AS (
    SELECT entity AS id, 'phone' AS kind, phone AS value, first_id, pos FROM company_phone
    UNION ALL SELECT entity, 'email', email, first_id, pos FROM company_email
),
everything AS (
    SELECT * FROM had UNION ALL SELECT id, kind, value, 4611686018427387904, pos FROM offered ANTI JOIN had USING (id, kind, value)
),
listed AS (
    SELECT id, coalesce(string_agg(value, ';' ORDER BY first_id, pos) FILTER (kind = 'phone'), '') AS phones,
           coalesce(string_agg(value, ';' ORDER BY first_id, pos) FILTER (kind = 'email'), '') AS emails,
           count(*) FILTER (kind = 'phone') AS n_phones, count(*) FILTER (kind = 'email') AS n_emails
    FROM everything GROUP BY id
),
final AS (
    SELECT t.id, t.city, name_best AS name, CASE WHEN clean IS NULL AND m IS NOT NULL THEN 'https://found' || m || '.example.ru' ELSE clean END AS website,
           merged_from, cms, quiz, tg, wa, trust, needs_review, coalesce(l.phones, '') AS phones, coalesce(l.emails, '') AS emails,
           coalesce(l.n_phones, 0) AS n_phones, coalesce(l.n_emails, 0) AS n_emails
    FROM trusted t LEFT JOIN chosen c USING (id) LEFT JOIN listed l USING (id)
),
held AS (
    SELECT f.id, f.city, 'p:' || value AS key FROM everything JOIN final f USING (id) WHERE kind = 'phone'
    UNION ALL SELECT id, city, 's:' || regexp_replace(regexp_extract(website, '^https://([^/]*)', 1), '^www\.', '') FROM final WHERE website IS NOT NULL
),
branch AS (SELECT DISTINCT id FROM held JOIN (SELECT city, key FROM held GROUP BY ALL HAVING count(DISTINCT id) > 1) USING (city, key)),
valued AS (
    SELECT *, id IN (SELECT id FROM branch) AS is_network,
           (CASE WHEN website IS NOT NULL THEN 5 + (CASE WHEN cms = 'bitrix' THEN 10 WHEN cms IN ('wordpress', 'tilda', 'flexbe') THEN 3 ELSE 0 END)
                 + (CASE WHEN quiz THEN 8 ELSE 0 END) ELSE 0 END + CASE WHEN tg IS NOT NULL THEN 15 + 2 * coalesce(trust, 0) ELSE 0 END
            + CASE WHEN wa IS NOT NULL THEN 10 ELSE 0 END + CASE WHEN n_phones > 1 THEN 5 ELSE 0 END + CASE WHEN n_emails > 0 THEN 5 ELSE 0 END
            + CASE WHEN id IN (SELECT id FROM branch) THEN 5 ELSE 0 END)::INTEGER AS crm_score
    FROM final
)
"""

# The listings of the whole run: every third one has a shop site with stored pages.
SHOP_LISTINGS = ("CASE WHEN k % 3 = 0 THEN (CASE WHEN k % 9", "CASE WHEN k % 3 = 1 THEN 'https://shop' || (k // 2) || '.example.ru/' WHEN k % 3 = 0 THEN (CASE WHEN k % 9")


@register(
    "full_run",
    listing_sql(
        """
SELECT id, city, name, website, phones, emails, merged_from, n_phones::INTEGER AS n_phones, n_emails::INTEGER AS n_emails, cms, is_network,
       needs_review, crm_score, CASE WHEN crm_score >= 50 THEN 'A' WHEN crm_score >= 30 THEN 'B' WHEN crm_score >= 15 THEN 'C' ELSE 'D' END AS segment
FROM valued""",
        COMPONENTS,
        MERGED,
        SHOPS,
        SCANNED,
        WHOLE_RUN,
    ).replace(*SHOP_LISTINGS),
)
def _(spark, folder):
    """Listings to scored companies: grouping, site scan, profiles, search hits, gap filling, networks, scores."""
    base = dealt_listings(spark, folder)
    shop = F.concat(derived_pages.shop_site(F.col("id")), F.lit("/"))
    rows = base.withColumn("website", F.when(F.col("id") % 3 == 1, shop).otherwise(F.col("website")))
    hits = search_results(derived_pages.search_answers(rows), 3).withColumnRenamed("name", "query_name")
    ranked = hits.groupBy("city", "query_name", "pos").agg(F.min_by(F.struct("url", "title"), "id").alias("hit"))
    details = sites(spark, folder).drop("id").withColumnRenamed("website", "url")
    companies = run(
        rows,
        derived_pages.shop_pages(base),
        derived_pages.profiles(base),
        ranked.select("city", "query_name", "pos", "hit.url", "hit.title"),
        details,
        rules=Rules(rank_titles=True),
    ).companies
    texts = with_joined_lists(companies.withColumn("merged_from", F.col("merged_from").cast("array<string>")), "phones", "emails", "merged_from")
    return texts.select(
        "id", "city", "name", "website", "phones", "emails", "merged_from", "n_phones", "n_emails", "cms", "is_network", "needs_review", "crm_score", "segment"
    )
