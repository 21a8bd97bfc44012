"""Links, site scans, search hits, gap filling and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollcall.functions.html import (
    cms_of,
    contact_link,
    has_quiz,
    page_links,
    profile_exists,
    profile_is_relevant,
    profile_trust,
    relevant_links,
    social_links,
)
from rollcall.functions.phones import normalize_phone
from rollcall.functions.urls import clean_website, domain_of, resolve_link, site_root
from rollcall.operators.gaps import best_hits, fill_gaps, fill_statistics, missing_contacts, only_new
from rollcall.operators.merge import fact_counts, nest, unnest
from rollcall.operators.picking import first_per_key
from rollcall.operators.site_scan import handle_candidates, scan_sites, verified_handles, visit_details
from rollcall.queries import register
from rollcall.queries.base import listing_sql, messenger_text, with_joined_lists
from rollcall.settings import RELEVANT_WORDS
from rollcall.sources import derived_pages
from rollcall.sources.driver_tables import enriched_listings, listings, sites, table
from rollcall.sources.search import search_results

LINK_SQL = r"""regexp_extract_all(html, '(?i)<a\s[^>]*href=["'']([^"'']+)["'']', 1)"""
ROOT_SQL = "regexp_extract(url, '^[^:/?#]+://[^/?#]*')"


@register(
    "page_links",
    f"""
SELECT page_id, pos - 1 AS pos, href, {ROOT_SQL} || href AS target
FROM (SELECT page_id, url, unnest(links) AS href, generate_subscripts(links, 1) AS pos FROM (SELECT *, {LINK_SQL} AS links FROM pages))""",
)
def _(spark, folder):
    each = table(spark, folder, "pages").select("page_id", "url", F.posexplode(page_links(F.col("html"))).alias("pos", "href"))
    return each.select(
        "page_id", F.col("pos").cast("long").alias("pos"), "href", resolve_link(F.col("url"), F.col("href")).alias("target")
    )


RELEVANT = ("an", "er", "de", "que")


@register(
    "relevant_links",
    f"""
WITH fit AS (
    SELECT page_id, {ROOT_SQL} AS root,
           list_filter({LINK_SQL}, lambda h: {" OR ".join(f"contains(lower(h), '{w}')" for w in RELEVANT)}) AS links FROM pages
), once AS (
    SELECT page_id, root, list_filter(links, lambda h, i: list_position(list_transform(links, lambda y: lower(y)), lower(h)) = i) AS links FROM fit
)
SELECT page_id, array_to_string(list_transform(links[1:3], lambda h: root || h), ' ') AS links FROM once""",
)
def _(spark, folder):
    base = F.regexp_extract("url", r"^[^:/?#]+://[^/?#]*", 0)
    links = relevant_links(F.col("html"), base, RELEVANT)
    return table(spark, folder, "pages").select("page_id", F.array_join(links, " ").alias("links"))


SHOPS = "shops AS (SELECT DISTINCT id // 2 AS s FROM listings)"


@register(
    "contact_links",
    listing_sql(
        """
SELECT 'https://shop' || s || '.example.ru/' AS url, CASE WHEN s % 7 <> 0 THEN 'https://shop' || s || '.example.ru/kontakty/' END AS contact FROM shops""",
        SHOPS,
    ),
)
def _(spark, folder):
    pages = derived_pages.shop_pages(listings(spark, folder)).where(F.col("url").rlike("ru/$"))
    return pages.select("url", contact_link(F.col("html"), site_root(F.col("url"))).alias("contact"))


@register(
    "social_links",
    listing_sql(
        """
SELECT 'https://shop' || s || '.example.ru/' AS url,
       concat_ws(';', CASE WHEN s % 3 = 0 THEN 'telegram=https://t.me/shop' || s END,
                      CASE WHEN s % 5 = 0 THEN 'vk=https://www.vk.com/shop' || s END) AS found FROM shops
UNION ALL
SELECT 'https://shop' || s || '.example.ru/kontakty/',
       concat_ws(';', CASE WHEN s % 6 = 2 THEN 'telegram=https://telegram.me/late' || s END,
                      CASE WHEN s % 6 = 1 THEN 'whatsapp=https://wa.me/7900' || s END) FROM shops
UNION ALL SELECT 'https://shop' || s || '.example.ru/about', CASE WHEN s % 10 = 3 THEN 'telegram=https://t.me/about' || s ELSE '' END FROM shops
UNION ALL
SELECT 'https://shop' || s || '.example.ru/katalog?x=1',
       CASE WHEN s % 10 = 5 THEN 'whatsapp=https://api.whatsapp.com/send?phone=7' || s ELSE '' END FROM shops
UNION ALL SELECT 'https://shop' || s || '.example.ru/uslugi', CASE WHEN s % 2 = 1 THEN 'vk=http://vk.com/offer' || s ELSE '' END FROM shops
UNION ALL SELECT 'https://shop' || s || '.example.ru/services', 'vk=https://vk.com/never' FROM shops""",
        SHOPS,
    ),
)
def _(spark, folder):
    pages = derived_pages.shop_pages(listings(spark, folder))
    found = pages.select("url", social_links(F.col("html")).alias("messengers"))
    return found.select("url", messenger_text().alias("found"))


@register(
    "cms_fingerprint",
    listing_sql(
        """
SELECT 'https://shop' || s || '.example.ru/' AS url,
       (['unknown', 'wordpress', 'bitrix', 'tilda', 'flexbe', 'lpmotor', 'joomla', 'opencart'])[(s % 8) + 1] AS cms,
       s % 9 = 0 AS has_marquiz FROM shops""",
        SHOPS,
    ),
)
def _(spark, folder):
    pages = derived_pages.shop_pages(listings(spark, folder)).where(F.col("url").rlike("ru/$"))
    return pages.select("url", cms_of(F.col("html")).alias("cms"), has_quiz(F.col("html")).alias("has_marquiz"))


PAGE_MARKS = (("spanish", ('lang="es"', "ción")), ("german", ('lang="de"', "sch")), ("tracked", ("track(",)))


@register(
    "page_fingerprint",
    "SELECT page_id, CASE "
    + " ".join(f"WHEN {' OR '.join(f'''contains(html, '{w}')''' for w in words)} THEN '{name}'" for name, words in PAGE_MARKS)
    + " ELSE 'unknown' END AS builder, contains(html, '<nav>') AS has_widget FROM pages",
)
def _(spark, folder):
    html = F.col("html")
    return table(spark, folder, "pages").select("page_id", cms_of(html, PAGE_MARKS).alias("builder"), has_quiz(html, "<nav>").alias("has_widget"))


# Messengers, builder and widget of every shop site, from what its pages are known to hold.
SCANNED = """
home AS (
    SELECT s, CASE WHEN s % 3 = 0 THEN 'https://t.me/shop' || s END AS tg, CASE WHEN s % 5 = 0 THEN 'https://www.vk.com/shop' || s END AS vk
    FROM shops WHERE s % 13 <> 0
),
further AS (
    SELECT *, tg IS NULL AND s % 7 <> 0 AS visited,
           CASE WHEN s % 6 = 2 THEN 'https://telegram.me/late' || s WHEN s % 10 = 3 THEN 'https://t.me/about' || s END AS tg2,
           CASE WHEN s % 6 = 1 THEN 'https://wa.me/7900' || s WHEN s % 10 = 5 THEN 'https://api.whatsapp.com/send?phone=7' || s END AS wa2,
           CASE WHEN s % 2 = 1 THEN 'http://vk.com/offer' || s END AS vk2
    FROM home
),
linked AS (
    SELECT *, CASE WHEN visited THEN coalesce(tg, tg2) ELSE tg END AS telegram, CASE WHEN visited THEN wa2 END AS whatsapp FROM further
),
scanned AS (
    SELECT s, telegram, whatsapp,
           CASE WHEN visited AND NOT (telegram IS NOT NULL AND whatsapp IS NOT NULL) THEN coalesce(vk, vk2) ELSE vk END AS vk,
           (['unknown', 'wordpress', 'bitrix', 'tilda', 'flexbe', 'lpmotor', 'joomla', 'opencart'])[(s % 8) + 1] AS cms,
           s % 9 = 0 AS has_marquiz
    FROM linked
)
"""


@register(
    "site_scan",
    listing_sql(
        """
SELECT 'https://shop' || s || '.example.ru' AS site, cms, has_marquiz,
       concat_ws(';', 'telegram=' || telegram, 'vk=' || vk, 'whatsapp=' || whatsapp) AS messengers
FROM scanned""",
        SHOPS,
        SCANNED,
    ),
)
def _(spark, folder):
    rows = listings(spark, folder)
    wanted = rows.select(site_root(clean_website(F.concat(derived_pages.shop_site(F.col("id")), F.lit("/")))).alias("site"))
    scanned = scan_sites(wanted, derived_pages.shop_pages(rows))
    return scanned.withColumn("messengers", messenger_text())


@register(
    "visit_details",
    listing_sql(
        """
, text AS (SELECT id, id // 2 AS s, 'https://shop' || (id // 2) || '.example.ru' AS url FROM listings WHERE id % 6 < 4)
SELECT url, '+7 (495) 123-45-' || lpad((id % 100)::VARCHAR, 2, '0') AS phones, 'box' || id || '@example.ru' AS emails,
       CASE WHEN s % 13 = 0 THEN 'unknown'
            ELSE (['unknown', 'wordpress', 'bitrix', 'tilda', 'flexbe', 'lpmotor', 'joomla', 'opencart'])[(s % 8) + 1] END AS cms,
       s % 13 <> 0 AND s % 3 = 0 AS home_telegram
FROM text"""
    ),
)
def _(spark, folder):
    rows = listings(spark, folder)
    fetched = derived_pages.noisy_outputs(rows).withColumn("url", derived_pages.shop_site(F.col("id")))
    found = with_joined_lists(visit_details(fetched, derived_pages.shop_pages(rows)), "phones", "emails")
    home = F.try_element_at("messengers", F.lit("telegram")).like("https://t.me/shop%")
    return found.select("url", "phones", "emails", "cms", F.coalesce(home, F.lit(False)).alias("home_telegram"))


@register(
    "first_page_per_domain",
    r"""
SELECT domain, min(page_id) AS page_id, min_by(url, page_id) AS url
FROM (SELECT *, regexp_replace(lower(regexp_extract(url, '^[^:/?#]+://([^/?#]*)', 1)), '^www\.', '') AS domain FROM pages)
GROUP BY domain""",
)
def _(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url", domain_of(F.col("url")).alias("domain"))
    return first_per_key(pages, ["domain"], "page_id")


HITS = """
hit AS (
    SELECT id, name, lower(split_part(name, ' ', 1)) AS word, CASE WHEN id % 8 IN (0, 1) THEN false ELSE true END AS readable FROM listings
)
"""


@register(
    "search_hits",
    listing_sql(
        """
SELECT id, 0 AS pos, 'https://portal.example.ru/' || (id // 5) AS url, 'Portal' AS title FROM hit WHERE readable
UNION ALL SELECT id, 1, CASE WHEN id % 11 = 0 THEN '' ELSE 'https://found' || id || '.example.ru' END,
                 CASE id % 3 WHEN 0 THEN 'About ' || word WHEN 1 THEN 'Other' ELSE '' END FROM hit WHERE readable
UNION ALL SELECT id, 2, 'https://third' || id || '.example.ru', word || ' LLC' FROM hit WHERE readable""",
        HITS,
    ),
)
def _(spark, folder):
    answers = derived_pages.search_answers(listings(spark, folder)).select("id", "body")
    return search_results(answers, 3).select("id", "pos", "url", "title")


@register(
    "best_hit",
    listing_sql(
        """
SELECT id, CASE WHEN id % 3 = 0 AND id % 11 <> 0 THEN 'https://found' || id || '.example.ru'
                ELSE 'https://third' || id || '.example.ru' END AS url
FROM hit WHERE readable""",
        HITS,
    ),
)
def _(spark, folder):
    rows = listings(spark, folder)
    hits = search_results(derived_pages.search_answers(rows).select("id", "body"), 3)
    return best_hits(rows.select("id", "name"), hits)


@register(
    "first_hit",
    listing_sql("SELECT id, 'https://portal.example.ru/' || (id // 5) AS url FROM hit WHERE readable", HITS),
)
def _(spark, folder):
    rows = listings(spark, folder)
    hits = search_results(derived_pages.search_answers(rows).select("id", "body"), 3)
    return best_hits(rows.select("id", "name"), hits, rank_titles=False)


@register(
    "missing_contacts",
    listing_sql("SELECT id, city FROM listings l WHERE website IS NULL OR id NOT IN (SELECT id FROM email)"),
)
def _(spark, folder):
    return missing_contacts(enriched_listings(spark, folder)).select("id", "city")


@register(
    "only_new",
    listing_sql(
        "SELECT id, city FROM listings WHERE id NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL AND o_orderstatus = 'P')"
    ),
)
def _(spark, folder):
    orders = table(spark, folder, "orders").where("o_orderstatus = 'P'")
    done = orders.select(F.col("o_custkey").alias("id"))
    return only_new(listings(spark, folder), done).select("id", "city")


FILL = """
visit AS (
    SELECT id, number, k2.num7, phones[1] AS phone1 FROM listings JOIN (SELECT id, lpad((id % 10000000)::VARCHAR, 7, '0') AS num7 FROM listings) k2 USING (id)
    WHERE (id % 3 <> 0 OR id % 2 = 1) AND (website IS NULL OR id NOT IN (SELECT id FROM email))
),
offer AS (
    SELECT v.id, 'phone' AS kind, 0 AS pos, p.p AS value FROM visit v JOIN phone_values p ON p.id = v.id AND p.pos = 1
        WHERE length(p.p) = 11 AND p.p[1] = '7'
    UNION ALL SELECT id, 'phone', 1, '7955' || num7 FROM visit
    UNION ALL SELECT id, 'email', 0, 'found' || id || '@example.ru' FROM visit
),
known AS (SELECT id, 'phone' AS kind, phone AS value, pos FROM phone UNION ALL SELECT id, 'email', email, pos FROM email),
fresh AS (SELECT o.* FROM offer o ANTI JOIN known USING (id, kind, value)),
every AS (SELECT id, kind, value, 0 AS late, pos FROM known UNION ALL SELECT id, kind, value, 1, pos FROM fresh),
filled AS (
    SELECT l.id, l.city, l.id IN (SELECT id FROM visit) AS visited, website AS old_site, telegram AS old_tg, vk AS old_vk, whatsapp, cms AS old_cms
    FROM listings l
),
done AS (
    SELECT *, visited AND old_site IS NULL AS site_new, visited AND id % 2 = 0 AND old_tg IS NULL AS tg_new,
           visited AND id % 7 = 0 AND old_vk IS NULL AS vk_new, visited AND id % 3 = 1 AND old_cms = 'unknown' AS cms_new
    FROM filled
),
added AS (
    SELECT id, 'website' AS field FROM done WHERE site_new UNION ALL SELECT id, 'telegram' FROM done WHERE tg_new
    UNION ALL SELECT id, 'vk' FROM done WHERE vk_new UNION ALL SELECT id, 'cms' FROM done WHERE cms_new
    UNION ALL SELECT id, kind FROM fresh
)
"""


def filled_listings(spark, folder):
    rows = enriched_listings(spark, folder)
    facts = unnest(rows)
    companies = rows.drop("phones", "emails").join(fact_counts(facts), "id", "left").na.fill(0, ["n_phones", "n_emails"])
    details = sites(spark, folder).withColumnRenamed("website", "url")
    return companies, fill_gaps(companies, facts, details)


@register(
    "gap_fill",
    listing_sql(
        """
SELECT id, city, CASE WHEN site_new THEN 'https://found' || id || '.example.ru' ELSE old_site END AS website,
       concat_ws(';', 'telegram=' || (CASE WHEN tg_new THEN 'https://t.me/found' || id ELSE old_tg END),
                 'vk=' || (CASE WHEN vk_new THEN 'https://vk.com/found' || id ELSE old_vk END), 'whatsapp=' || whatsapp) AS messengers,
       CASE WHEN cms_new THEN 'tilda' ELSE old_cms END AS cms,
       coalesce((SELECT string_agg(value, ';' ORDER BY late, pos) FROM every e WHERE e.id = done.id AND kind = 'phone'), '') AS phones,
       coalesce((SELECT string_agg(value, ';' ORDER BY late, pos) FROM every e WHERE e.id = done.id AND kind = 'email'), '') AS emails,
       (SELECT count(*) FROM every e WHERE e.id = done.id AND kind = 'phone')::INTEGER AS n_phones,
       (SELECT count(*) FROM every e WHERE e.id = done.id AND kind = 'email')::INTEGER AS n_emails
FROM done""",
        FILL,
    ),
)
def _(spark, folder):
    _, filled = filled_listings(spark, folder)
    rows = nest(filled.companies, filled.facts).withColumn("messengers", messenger_text())
    return with_joined_lists(rows, "phones", "emails").select(
        "id", "city", "website", "messengers", "cms", "phones", "emails", "n_phones", "n_emails"
    )


@register(
    "fill_statistics",
    listing_sql(
        """
SELECT field, count(*) AS values_added, count(DISTINCT id) AS companies FROM added GROUP BY field
UNION ALL SELECT 'improved', count(*), count(DISTINCT id) FROM added
UNION ALL SELECT 'attempted', 0, count(*) FROM listings WHERE website IS NULL OR id NOT IN (SELECT id FROM email)""",
        FILL,
    ),
)
def _(spark, folder):
    companies, filled = filled_listings(spark, folder)
    return fill_statistics(filled, missing_contacts(companies))


@register(
    "profile_trust",
    listing_sql(
        """
SELECT 'https://t.me/shop' || id AS url, id % 2 = 0 AS has_avatar, id % 3 = 0 AS has_description, id % 7 = 0 AS is_bot, id % 5 = 0 AS is_channel,
       ((id % 2 = 0)::INTEGER + (id % 3 = 0)::INTEGER - (id % 5 = 0)::INTEGER - (id % 7 = 0)::INTEGER) AS trust_score,
       id % 4 = 0 AS profile_exists, id % 3 = 0 AS is_relevant FROM listings"""
    ),
)
def _(spark, folder):
    html = F.col("html")
    pages = derived_pages.profiles(listings(spark, folder))
    return pages.select(
        "url",
        profile_trust(html).alias("trust"),
        profile_exists(html).alias("profile_exists"),
        profile_is_relevant(html, RELEVANT_WORDS).alias("is_relevant"),
    ).select("url", "trust.*", "profile_exists", "is_relevant")


@register(
    "verified_handles",
    listing_sql(
        """
SELECT id, 'https://t.me/shop' || (CASE WHEN id % 2 = 0 THEN id ELSE id + 1 END) AS url FROM listings
WHERE CASE WHEN id % 2 = 0 THEN id % 3 = 0 ELSE (id + 1) % 3 = 0 AND id + 1 IN (SELECT id FROM listings) AND length('shop' || (id + 1)) >= 5 END
  AND length('shop' || id) >= 5"""
    ),
)
def _(spark, folder):
    rows = listings(spark, folder)
    key = F.when(F.col("id") % 2 == 0, F.col("id")).otherwise(F.col("id") + 1)
    named = rows.select("id", F.concat(F.lit("Shop "), key.cast("string")).alias("name"), F.lit(None).cast("string").alias("phone"))
    return verified_handles(handle_candidates(named), derived_pages.profiles(rows))


@register(
    "primary_phones",
    listing_sql("SELECT l.id, min_by(phone, pos) AS phone, count(phone)::INTEGER AS n_phones FROM listings l LEFT JOIN phone USING (id) GROUP BY l.id"),
)
def _(spark, folder):
    rows = enriched_listings(spark, folder)
    counted = rows.select("id").join(fact_counts(unnest(rows)), "id", "left")
    return counted.select("id", normalize_phone(F.col("phone")).alias("phone"), F.coalesce("n_phones", F.lit(0)).alias("n_phones"))
