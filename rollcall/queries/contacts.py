"""Phones, e-mails and websites of listings and texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollcall.functions.emails import emails_in_text, is_valid_email, valid_emails
from rollcall.functions.phones import is_valid_phone, normalize_phones, phones_in_text, strip_separators
from rollcall.functions.urls import clean_website, domain_of, is_internal_url, page_number
from rollcall.queries import register
from rollcall.queries.base import joined, listing_sql
from rollcall.sources.driver_tables import listings, table

EMAIL_SQL = r"[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}"
PHONE_SQL = r"\+1[\s\-()]*\d{3}[\s\-()]*\d{3}[\s\-()]*\d{2}[\s\-()]*\d{2}"

TEXTS = """
    SELECT 'documents' AS kind, doc_id AS id, text FROM documents
    UNION ALL SELECT 'pages', page_id, html FROM pages
    UNION ALL SELECT 'conversations', conv_id * 1000 + turn, text FROM conversations
"""


def all_texts(spark, folder):
    documents = table(spark, folder, "documents").select(F.lit("documents").alias("kind"), F.col("doc_id").alias("id"), "text")
    pages = table(spark, folder, "pages").select(F.lit("pages").alias("kind"), F.col("page_id").alias("id"), F.col("html").alias("text"))
    talks = table(spark, folder, "conversations").select(
        F.lit("conversations").alias("kind"), (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text"
    )
    return documents.unionByName(pages).unionByName(talks)


@register(
    "normalize_phones",
    listing_sql(
        """
SELECT l.id, coalesce(string_agg(phone, ';' ORDER BY pos), '') AS phones
FROM listings l LEFT JOIN phone USING (id) GROUP BY l.id"""
    ),
)
def _(spark, folder):
    return listings(spark, folder).select("id", joined(normalize_phones(F.col("phones"))).alias("phones"))


@register(
    "phone_validity",
    listing_sql(
        r"""
SELECT id, pos - 1 AS pos, raw, regexp_matches(regexp_replace(raw, '[^0-9]', '', 'g'), '^7[0-9]{10}$') AS valid,
       translate(raw, '- ()', '') AS bare
FROM (SELECT id, generate_subscripts(phones, 1) AS pos, unnest(phones) AS raw FROM listings)"""
    ),
)
def _(spark, folder):
    each = listings(spark, folder).select("id", F.posexplode("phones").alias("pos", "raw"))
    return each.select(
        "id",
        F.col("pos").cast("long").alias("pos"),
        "raw",
        is_valid_phone(F.col("raw")).alias("valid"),
        strip_separators(F.col("raw")).alias("bare"),
    )


@register(
    "valid_emails",
    listing_sql(
        """
SELECT l.id, coalesce(string_agg(email, ';' ORDER BY pos), '') AS emails, len(l.emails)::BIGINT AS listed,
       count(email) AS valid
FROM listings l LEFT JOIN email USING (id) GROUP BY l.id, l.emails"""
    ),
)
def _(spark, folder):
    kept = valid_emails(F.col("emails"))
    return listings(spark, folder).select(
        "id",
        joined(kept).alias("emails"),
        F.size("emails").cast("long").alias("listed"),
        F.size(F.filter("emails", is_valid_email)).cast("long").alias("valid"),
    )


@register(
    "extract_emails",
    f"""
SELECT kind, id, array_to_string(list_sort(list_distinct(regexp_extract_all(text, '{EMAIL_SQL}'))), ';') AS emails
FROM ({TEXTS})""",
)
def _(spark, folder):
    return all_texts(spark, folder).select("kind", "id", joined(emails_in_text(F.col("text"))).alias("emails"))


@register(
    "extract_phones",
    rf"""
SELECT kind, id, array_to_string(found, ';') AS written,
       array_to_string(list_transform(found, lambda x: regexp_replace(x, '[^0-9]', '', 'g')), ';') AS digits
FROM (SELECT kind, id, regexp_extract_all(text, '{PHONE_SQL}') AS found FROM ({TEXTS}))
WHERE len(found) > 0""",
)
def _(spark, folder):
    found = all_texts(spark, folder).select("kind", "id", phones_in_text(F.col("text"), "1", plus_optional=False).alias("found"))
    digits = F.transform("found", lambda x: F.regexp_replace(x, "[^0-9]", ""))
    return found.where(F.size("found") > 0).select("kind", "id", joined("found").alias("written"), joined(digits).alias("digits"))


@register(
    "page_addresses",
    r"""
SELECT page_id, regexp_replace(lower(regexp_extract(url, '^[^:/?#]+://([^/?#]*)', 1)), '^www\.', '') AS domain,
       replace(lower(regexp_extract(url, '^[^:/?#]+://([^/?#]*)', 1)), 'www.', '') AS literal_domain,
       coalesce(try_cast(nullif(regexp_extract(url, 'page-?(\d+)', 1), '') AS INTEGER),
                try_cast(nullif(regexp_extract(url, 'page=(\d+)', 1), '') AS INTEGER), 1) AS page
FROM pages""",
)
def _(spark, folder):
    url = F.col("url")
    return table(spark, folder, "pages").select(
        "page_id", domain_of(url).alias("domain"), domain_of(url, literal=True).alias("literal_domain"), page_number(url).alias("page")
    )


@register(
    "clean_websites",
    listing_sql(
        """
SELECT id, website, CASE WHEN starts_with(w, 'http') THEN w ELSE 'https://' || w END AS clean,
       (SELECT domain FROM domain d WHERE d.id = l.id) AS domain
FROM (SELECT id, CASE WHEN id % 10 = 1 THEN '-' WHEN id % 10 = 4 THEN 'N/A' ELSE website END AS website,
             CASE WHEN website IS NULL OR id % 10 IN (1, 4) THEN NULL ELSE website END AS w FROM listings) l
"""
    ).replace("(SELECT domain FROM domain d WHERE d.id = l.id)", "(SELECT max(domain) FROM domain d WHERE d.id = l.id)"),
)
def _(spark, folder):
    rows = listings(spark, folder)
    key = F.col("id") % 10
    spoiled = F.when(key == 1, "-").when(key == 4, "N/A").otherwise(F.col("website"))
    return rows.select(
        "id",
        spoiled.alias("website"),
        clean_website(spoiled).alias("clean"),
        domain_of(F.col("website")).alias("domain"),
    )


OCTET = "([10, 172, 192, 169, 0, 100, 198, 203, 8, 127])[(k % 10) + 1]"


@register(
    "internal_urls",
    f"""
WITH addresses AS (
    SELECT c_custkey AS k, c_custkey AS id, {OCTET.replace('k %', 'c_custkey %')} AS a, (c_custkey // 10) % 256 AS b,
           (c_custkey // 7) % 3 AS c, c_custkey % 256 AS d FROM customer
), numbered AS (SELECT *, a * 16777216 + b * 65536 + c * 256 + d AS number FROM addresses)
SELECT id, 'http://' || a || '.' || b || '.' || c || '.' || d || ':8080/x' AS url,
       (a = 10) OR (a = 172 AND b BETWEEN 16 AND 31) OR (a = 192 AND b = 168) OR (a = 169 AND b = 254) OR (a = 0)
       OR (a = 100 AND b BETWEEN 64 AND 127) OR (a = 192 AND b = 0 AND c IN (0, 2)) OR (a = 198 AND b = 51 AND c = 100)
       OR (a = 203 AND b = 0 AND c = 113) OR (a = 127 AND b = 0 AND c = 0 AND d = 1) AS internal
FROM numbered
UNION ALL SELECT -page_id - 1, url, false FROM pages""",
)
def _(spark, folder):
    k = F.col("c_custkey")
    first = F.element_at(F.array(*[F.lit(o) for o in (10, 172, 192, 169, 0, 100, 198, 203, 8, 127)]), (k % 10 + 1).cast("int"))
    parts = [first, F.expr("(c_custkey div 10) % 256"), F.expr("(c_custkey div 7) % 3"), k % 256]
    host = F.concat_ws(".", *[p.cast("string") for p in parts])
    built = table(spark, folder, "customer").select(
        k.alias("id"), F.concat(F.lit("http://"), host, F.lit(":8080/x")).alias("url")
    )
    stored = table(spark, folder, "pages").select((-F.col("page_id") - 1).alias("id"), "url")
    return built.unionByName(stored).select("id", "url", is_internal_url(F.col("url")).alias("internal"))
