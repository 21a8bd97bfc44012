"""Networks, scores, segments and presets over listings in the shape of enriched companies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.operators.network import domain_counts, flag_networks, phone_counts
from rollcall.operators.presets import apply_preset
from rollcall.operators.scoring import score_companies, segment_histogram, top_scored
from rollcall.queries import register
from rollcall.queries.base import listing_sql, messenger_text, with_joined_lists
from rollcall.scratch import keep
from rollcall.settings import PRESETS, WEIGHTS
from rollcall.sources.driver_tables import enriched_listings, table

NETWORK = """
frequent_phone AS (SELECT city, phone, count(DISTINCT id) AS n FROM phone GROUP BY ALL HAVING count(DISTINCT id) >= 2),
frequent_domain AS (SELECT city, domain, count(*) AS n FROM domain GROUP BY ALL HAVING count(*) >= 2),
network AS (
    SELECT id FROM domain JOIN frequent_domain USING (city, domain)
    UNION SELECT id FROM phone JOIN frequent_phone USING (city, phone)
)
"""

SCORED = """
contact AS (
    SELECT l.id, coalesce((SELECT string_agg(phone, ';' ORDER BY pos) FROM phone p WHERE p.id = l.id), '') AS phone_text,
           coalesce((SELECT string_agg(email, ';' ORDER BY pos) FROM email e WHERE e.id = l.id), '') AS email_text,
           (SELECT count(*) FROM phone p WHERE p.id = l.id) AS n_phones, (SELECT count(*) FROM email e WHERE e.id = l.id) AS n_emails
    FROM listings l
),
scored_base AS (
    SELECT l.*, phone_text, email_text, n_phones, n_emails, l.id IN (SELECT id FROM network) AS is_network,
           (CASE WHEN website IS NOT NULL THEN 5 + (CASE WHEN cms = 'bitrix' THEN 10 WHEN cms IN ('wordpress', 'tilda', 'flexbe') THEN 3 ELSE 0 END)
                      + (CASE WHEN has_marquiz THEN 8 ELSE 0 END) ELSE 0 END
            + CASE WHEN telegram IS NOT NULL THEN 15 + 2 * trust_score ELSE 0 END
            + CASE WHEN whatsapp IS NOT NULL THEN 10 ELSE 0 END + CASE WHEN n_phones > 1 THEN 5 ELSE 0 END
            + CASE WHEN n_emails > 0 THEN 5 ELSE 0 END + CASE WHEN l.id IN (SELECT id FROM network) THEN 5 ELSE 0 END)::INTEGER AS crm_score
    FROM listings l JOIN contact c USING (id)
),
scored AS (SELECT *, CASE WHEN crm_score >= 50 THEN 'A' WHEN crm_score >= 30 THEN 'B' WHEN crm_score >= 15 THEN 'C' ELSE 'D' END AS segment FROM scored_base)
"""


def scored_listings(spark, folder):
    return score_companies(flag_networks(enriched_listings(spark, folder)))


@register("frequent_domains", listing_sql("SELECT city, domain, n FROM frequent_domain", NETWORK))
def _(spark, folder):
    return domain_counts(enriched_listings(spark, folder))


@register(
    "frequent_page_hosts",
    r"""
SELECT domain, count(*) AS n FROM (
    SELECT regexp_replace(lower(regexp_extract(url, '^[^:/?#]+://([^/?#]*)', 1)), '^www\.', '') AS domain FROM pages)
GROUP BY domain HAVING count(*) >= 2""",
)
def _(spark, folder):
    return domain_counts(table(spark, folder, "pages").select(F.col("url").alias("website")), scope=())


@register("frequent_phones", listing_sql("SELECT city, phone, n FROM frequent_phone", NETWORK))
def _(spark, folder):
    return phone_counts(enriched_listings(spark, folder))


@register(
    "phone_occurrences",
    listing_sql("SELECT city, p AS phone, count(*) AS n FROM phone_values WHERE length(p) = 11 AND p[1] = '7' GROUP BY ALL HAVING count(*) >= 2"),
)
def _(spark, folder):
    from rollcall.sources.driver_tables import listings

    return phone_counts(listings(spark, folder), occurrences=True)


@register("network_flags", listing_sql("SELECT id, city, id IN (SELECT id FROM network) AS is_network FROM listings", NETWORK))
def _(spark, folder):
    return flag_networks(enriched_listings(spark, folder)).select("id", "city", "is_network")


@register(
    "network_flags_everywhere",
    listing_sql(
        """
, p AS (SELECT phone FROM phone GROUP BY phone HAVING count(DISTINCT id) >= 3),
d AS (SELECT domain FROM domain GROUP BY domain HAVING count(*) >= 3)
SELECT id, id IN (SELECT id FROM phone SEMI JOIN p USING (phone)) OR id IN (SELECT id FROM domain SEMI JOIN d USING (domain)) AS is_network
FROM listings"""
    ),
)
def _(spark, folder):
    return flag_networks(enriched_listings(spark, folder), scope=(), threshold=3).select("id", "is_network")


@register(
    "score_segments",
    listing_sql("SELECT id, city, is_network, crm_score, segment FROM scored", NETWORK, SCORED),
)
def _(spark, folder):
    return scored_listings(spark, folder).select("id", "city", "is_network", "crm_score", "segment")


@register("segment_histogram", listing_sql("SELECT city, segment, count(*) AS companies FROM scored GROUP BY ALL", NETWORK, SCORED))
def _(spark, folder):
    return segment_histogram(scored_listings(spark, folder))


@register(
    "top_scored",
    listing_sql("SELECT id, city, name, crm_score, segment FROM scored ORDER BY crm_score DESC, id LIMIT 20", NETWORK, SCORED),
)
def _(spark, folder):
    return top_scored(scored_listings(spark, folder), 20).select("id", "city", "name", "crm_score", "segment")


# All weights doubled, so that every segment occurs.
DOUBLED = """
doubled AS (
    SELECT * REPLACE (CASE WHEN crm_score >= 50 THEN 'A' WHEN crm_score >= 30 THEN 'B' WHEN crm_score >= 15 THEN 'C' ELSE 'D' END AS segment)
    FROM (SELECT * REPLACE (crm_score * 2 AS crm_score) FROM scored)
)
"""


def doubled_listings(spark, folder):
    return score_companies(flag_networks(enriched_listings(spark, folder)), {name: 2 * weight for name, weight in WEIGHTS.items()})


PRESET_SQL = {
    "hot_leads": "telegram IS NOT NULL AND crm_score >= 50",
    "high_score": "segment = 'A'",
    "with_telegram": "telegram IS NOT NULL",
    "cold_email": "telegram IS NULL AND whatsapp IS NULL AND n_emails > 0",
    "manual_search": "telegram IS NULL AND whatsapp IS NULL",
    "full_dump": "true",
}
# What the same presets keep when conditions outside the literal list filter nothing.
LITERAL_SQL = PRESET_SQL | {"hot_leads": "telegram IS NOT NULL", "high_score": "true", "cold_email": "telegram IS NULL AND whatsapp IS NULL"}

PRESET_COLUMNS = """SELECT id, city, crm_score, segment, email_text AS emails,
    concat_ws(';', 'telegram=' || telegram, 'vk=' || vk, 'whatsapp=' || whatsapp) AS messengers FROM doubled WHERE """


def _preset_query(name: str, literal: bool):
    def query(spark, folder):
        chosen = apply_preset(doubled_listings(spark, folder), PRESETS[name]["filters"], literal)
        texts = chosen.withColumn("messengers", messenger_text()).select("id", "city", "crm_score", "segment", "emails", "messengers")
        return with_joined_lists(texts, "emails")

    return query


for _name in PRESETS:
    register(f"preset_{_name}", listing_sql(PRESET_COLUMNS + PRESET_SQL[_name], NETWORK, SCORED, DOUBLED))(_preset_query(_name, False))
for _name in ("hot_leads", "high_score", "cold_email"):
    register(f"literal_preset_{_name}", listing_sql(PRESET_COLUMNS + LITERAL_SQL[_name], NETWORK, SCORED, DOUBLED))(_preset_query(_name, True))


@register(
    "preset_conditions",
    listing_sql(
        PRESET_COLUMNS + "whatsapp IS NOT NULL AND n_emails > 0 AND crm_score >= 20", NETWORK, SCORED, DOUBLED
    ),
)
def _(spark, folder):
    filters = "whatsapp IS NOT NULL AND email IS NOT NULL and priority_score >= 20 AND has_production = 1 AND website_status = 200"
    chosen = apply_preset(doubled_listings(spark, folder), filters)
    texts = chosen.withColumn("messengers", messenger_text()).select("id", "city", "crm_score", "segment", "emails", "messengers")
    return with_joined_lists(texts, "emails")


@register(
    "preset_expressions",
    listing_sql(
        """
SELECT 'between' AS preset, id FROM scored WHERE crm_score BETWEEN 20 AND 40 AND (telegram IS NOT NULL OR lower(city) = 'nation_3')
UNION ALL SELECT 'function', id FROM scored WHERE lower(substr(name, 1, 1)) = 'b' AND city IN ('NATION_1', 'NATION_2')
UNION ALL SELECT 'not', id FROM scored WHERE NOT (segment = 'D' OR telegram IS NULL)""",
        NETWORK,
        SCORED,
    ),
)
def _(spark, folder):
    """Whole conditions: ranges, alternatives, functions, and one nothing meets."""
    presets = {
        "between": "crm_score BETWEEN 20 AND 40 AND (telegram IS NOT NULL OR lower(city) = 'nation_3')",
        "function": "lower(substr(name, 1, 1)) = 'b' and city IN ('NATION_1', 'NATION_2') AND no_such_column > 1",
        "not": "NOT (segment = 'D' OR telegram IS NULL)",
        "nothing": "1=0",
        "nobody": "lower(name) = 'nobody'",
    }
    rows = keep(scored_listings(spark, folder), "scored").df
    found = [apply_preset(rows, text).select(F.lit(name).alias("preset"), "id") for name, text in presets.items()]
    return reduce(DataFrame.unionByName, found)
