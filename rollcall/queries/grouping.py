"""Linking listings and merging them into companies."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollcall.operators.linkage import clean_contacts, clusters_by_key, phone_links, shared_domains, site_links
from rollcall.operators.merge import extend_entities, nest, resolve_entities
from rollcall.queries import register
from rollcall.queries.base import COMPONENTS, listing_sql, messenger_text, with_joined_lists
from rollcall.sinks.reports import conflict_lines
from rollcall.sources.driver_tables import listings, table

PHONE_COMPONENTS = COMPONENTS.replace(" UNION ALL SELECT city, 's:' || domain, id FROM domain", "")
SITE_COMPONENTS = COMPONENTS.replace("SELECT city, 'p:' || phone AS key, id FROM phone UNION ALL SELECT city, 's:' || domain, id", "SELECT city, 's:' || domain AS key, id")

CLUSTER_ROWS = """
SELECT l.city, entity AS cluster, id FROM component JOIN listings l USING (id)
WHERE entity IN (SELECT entity FROM component GROUP BY entity HAVING count(*) > 1)"""

MERGED = r"""
labelled AS (SELECT l.*, c.entity FROM listings l JOIN component c USING (id)),
street AS (SELECT entity, count(DISTINCT regexp_extract(lower(address_raw), 'ул\.\s*(.+?)[,\d]', 1)) AS streets
           FROM labelled GROUP BY entity),
company_phone AS (SELECT entity, phone, min(id) AS first_id, min_by(pos, id) AS pos
                  FROM phone JOIN component USING (id) GROUP BY ALL),
company_email AS (SELECT entity, email, min(id) AS first_id, min_by(pos, id) AS pos
                  FROM email JOIN component USING (id) GROUP BY ALL),
plain AS (
    SELECT entity AS id, min_by(city, id) AS city, first(name ORDER BY length(name) DESC, id) AS name_best,
           first(address_raw ORDER BY length(address_raw) DESC, id) AS address,
           first(website ORDER BY length(website) DESC, id) FILTER (website IS NOT NULL) AS website,
           count(*) AS n_listings, string_agg(id::VARCHAR, ';' ORDER BY id) AS merged_from,
           min_by(telegram, id) FILTER (telegram IS NOT NULL) AS telegram,
           min_by(vk, id) FILTER (vk IS NOT NULL) AS vk,
           min_by(whatsapp, id) FILTER (whatsapp IS NOT NULL) AS whatsapp
    FROM labelled GROUP BY entity
),
company AS (
    SELECT p.*, streets > 1 AS needs_review,
           coalesce((SELECT string_agg(phone, ';' ORDER BY first_id, pos) FROM company_phone q WHERE q.entity = p.id), '') AS phones,
           coalesce((SELECT string_agg(email, ';' ORDER BY first_id, pos) FROM company_email q WHERE q.entity = p.id), '') AS emails,
           (SELECT count(*) FROM company_phone q WHERE q.entity = p.id)::INTEGER AS n_phones,
           (SELECT count(*) FROM company_email q WHERE q.entity = p.id)::INTEGER AS n_emails
    FROM plain p JOIN street s ON s.entity = p.id
)
"""


@register("cluster_by_phone", listing_sql(CLUSTER_ROWS, PHONE_COMPONENTS))
def _(spark, folder):
    cleaned = clean_contacts(listings(spark, folder))
    return clusters_by_key(cleaned, phone_links(cleaned))


@register("cluster_by_site", listing_sql(CLUSTER_ROWS, SITE_COMPONENTS))
def _(spark, folder):
    rows = listings(spark, folder)
    return clusters_by_key(rows, site_links(rows))


@register(
    "shared_domains",
    listing_sql(
        """
, shared AS (SELECT city, domain, min(id) AS cluster FROM domain GROUP BY ALL HAVING count(*) > 1)
SELECT city, domain, cluster, id FROM domain JOIN shared USING (city, domain)"""
    ),
)
def _(spark, folder):
    return shared_domains(listings(spark, folder))


@register(
    "shared_page_hosts",
    r"""
WITH host AS (SELECT page_id AS id, regexp_replace(lower(regexp_extract(url, '^[^:/?#]+://([^/?#]*)', 1)), '^www\.', '') AS domain FROM pages),
shared AS (SELECT domain, min(id) AS cluster FROM host GROUP BY ALL HAVING count(*) > 1)
SELECT domain, cluster, id FROM host JOIN shared USING (domain)""",
)
def _(spark, folder):
    pages = table(spark, folder, "pages").select(F.col("page_id").alias("id"), F.col("url").alias("website"))
    return shared_domains(pages, scope=())


@register(
    "resolve_entities",
    listing_sql(
        """
SELECT id, city, name_best, address, website, n_listings, n_phones, n_emails, nullif(split_part(phones, ';', 1), '') AS phone, phones, emails, merged_from,
       concat_ws(';', 'telegram=' || telegram, 'vk=' || vk, 'whatsapp=' || whatsapp) AS messengers,
       'raw' AS status, needs_review, CASE WHEN needs_review THEN 'same_name_diff_address' ELSE '' END AS review_reason
FROM company""",
        COMPONENTS,
        MERGED,
    ),
)
def _(spark, folder):
    resolved = resolve_entities(listings(spark, folder))
    companies = nest(resolved.companies, resolved.facts)
    texts = companies.withColumn("messengers", messenger_text()).withColumn("merged_from", F.col("merged_from").cast("array<string>"))
    return with_joined_lists(texts, "phones", "emails", "merged_from")


@register("company_members", listing_sql("SELECT entity AS id, id AS listing_id FROM component", COMPONENTS))
def _(spark, folder):
    return resolve_entities(listings(spark, folder)).members


@register("extended_companies", listing_sql("SELECT entity AS id, id AS listing_id FROM component", COMPONENTS))
def _(spark, folder):
    """All listings, those that bridge two numbers after the others: stored companies join through late listings."""
    rows = listings(spark, folder)
    early = resolve_entities(rows.where(F.size("phones") < 2))
    return extend_entities(early.labelled, rows).members


@register(
    "company_contacts",
    listing_sql(
        """
SELECT entity AS id, 'phone' AS kind, phone AS value, first_id, pos - 1 AS pos FROM company_phone
UNION ALL SELECT entity, 'email', email, first_id, pos - 1 FROM company_email
UNION ALL SELECT entity, 'listing', id::VARCHAR, id, 0 FROM component""",
        COMPONENTS,
        MERGED,
    ),
)
def _(spark, folder):
    return resolve_entities(listings(spark, folder)).facts.withColumn("pos", F.col("pos").cast("long"))


@register(
    "merge_conflicts",
    listing_sql("SELECT id, city, n_listings FROM company WHERE needs_review", COMPONENTS, MERGED),
)
def _(spark, folder):
    companies = resolve_entities(listings(spark, folder)).companies
    return companies.where("needs_review").select("id", "city", "n_listings")


CONFLICT_REPORT = """
flagged AS (SELECT id AS entity, city, row_number() OVER (PARTITION BY city ORDER BY id) AS number FROM company WHERE needs_review),
variant AS (
    SELECT l.* EXCLUDE (number), f.number, row_number() OVER (PARTITION BY l.entity ORDER BY l.id) AS v,
           coalesce((SELECT string_agg(phone, ', ' ORDER BY pos) FROM phone p WHERE p.id = l.id), '') AS numbers
    FROM labelled l JOIN flagged f ON f.entity = l.entity
),
line AS (
    SELECT city, 0 AS number, 0 AS variant, unnest(['# Конфликты дедупликации — ' || city, '', '**Найдено конфликтов:** ' || count(*), '',
        'Для каждого конфликта отметьте правильный вариант `[x]`:', '', '---', '']) AS line, unnest(range(0, 8)) AS pos
    FROM flagged GROUP BY city
    UNION ALL
    SELECT city, number, 0, unnest(['## ' || number || '. Конфликт #' || entity, '', '**Причина:** same_name_diff_address', '']), unnest(range(0, 4))
    FROM flagged
    UNION ALL
    SELECT city, number, v, unnest(['- [ ] **Вариант ' || (CASE WHEN v <= 26 THEN chr((64 + v)::INTEGER)
               ELSE chr((65 + (v - 27) // 26)::INTEGER) || chr((65 + (v - 27) % 26)::INTEGER) END) || ':** ' || name,
        '  Адрес: ' || address_raw, '  Телефон: ' || numbers, '  Сайт: ' || coalesce(website, 'N/A'), '  Источник: ' || source, '  ID: ' || id, '']),
        unnest(range(0, 7))
    FROM variant
    UNION ALL
    SELECT city, number, 4611686018427387904, unnest(['- [ ] **Разные компании** (не объединять)', '', '---', '']), unnest(range(0, 4)) FROM flagged
)
SELECT city, number, variant, pos, line FROM line"""


@register("conflict_report", listing_sql(CONFLICT_REPORT.replace("\nflagged", "\n, flagged", 1), COMPONENTS, MERGED))
def _(spark, folder):
    resolved = resolve_entities(listings(spark, folder))
    return conflict_lines(resolved.labelled, resolved.companies)
