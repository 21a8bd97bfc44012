"""What the commands leave in their tables and files, read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rollcall.operators.merge import EMAIL, PHONE
from rollcall.operators.merge import LISTING as LISTED_ID
from rollcall.operators.merge import further_values, nest, resolve_entities
from rollcall.operators.scoring import segment_histogram
from rollcall.plans.commands import Workspace
from rollcall.plans.full_run import Rules
from rollcall.queries import register
from rollcall.queries.base import COMPONENTS, listing_sql
from rollcall.queries.enriching import SCANNED, SHOPS
from rollcall.queries.grouping import MERGED
from rollcall.queries.reporting import SHOP_LISTINGS, WHOLE_RUN
from rollcall.queries.scoring import NETWORK, SCORED, scored_listings
from rollcall.schema import LISTING
from rollcall.scratch import keep, scratch_path
from rollcall.sinks.reports import TOTAL_LINE, further_rows, markdown_lines, read_csv, read_further, write_csv, write_further
from rollcall.sinks.tables import append_listings, read_scope
from rollcall.sources import derived_pages
from rollcall.sources.driver_tables import dealt_listings, listings, sites
from rollcall.sources.search import search_results
from rollcall.streaming.ingest import ingest, listing_stream


def as_files(rows):
    """Rows in the columns of listing files."""
    return rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in LISTING.fields])


@register(
    "late_listings",
    listing_sql(
        """
, first AS (SELECT city, source_url, min(id) AS id FROM listings WHERE id % 2 = 0 GROUP BY ALL),
late AS (SELECT city, source_url, min(id) AS id FROM listings ANTI JOIN first USING (city, source_url) GROUP BY ALL)
SELECT city, source_url, id, 1700000000 AS scraped FROM first UNION ALL SELECT city, source_url, id, 1700000000 - 60 * 86400 FROM late"""
    ),
)
def _(spark, folder):
    """Two batches of listing files, the second with time stamps 60 days older: repeats go, late listings stay."""
    rows = listings(spark, folder)
    source, target, state = (scratch_path(spark, name) for name in ("incoming", "taken", "state"))
    for part, age in ((rows.where("id % 2 = 0"), 0), (rows, 60)):
        stamped = part.withColumn("scraped_at", F.timestamp_seconds(F.lit(1_700_000_000 - age * 86_400)))
        as_files(stamped).write.mode("append").parquet(source)
        ingest(listing_stream(spark, source), target, state)
    return spark.read.parquet(target).select("city", "source_url", "id", F.unix_timestamp("scraped_at").alias("scraped"))


@register(
    "large_company",
    listing_sql(
        """
, host AS (SELECT id, 'portal' AS domain FROM listings WHERE id % 3 = 0),
entity AS (SELECT l.id, CASE WHEN id % 3 = 0 THEN (SELECT min(id) FROM host) ELSE id END AS entity FROM listings l),
sized AS (SELECT entity AS id, count(*) AS n_listings FROM entity GROUP BY entity)
SELECT id, n_listings, least(n_listings, 50)::INTEGER AS listed, greatest(n_listings - 50, 0) AS further, 1 AS csv_rows,
       (SELECT count(*) FROM sized) AS markdown_total, (SELECT count(*) FROM sized) AS segment_total FROM sized"""
    ),
)
def _(spark, folder):
    """A third of all listings on one host: one row per company in lists, CSV, Markdown total and segments."""
    hosts = F.when(F.col("id") % 3 == 0, F.concat(F.lit("https://portal.example.ru/"), F.col("id").cast("string")))
    rows = listings(spark, folder).withColumns({"website": hosts, "city": F.lit("all")})
    resolved = resolve_entities(rows, keys=("site",))
    companies = keep(nest(resolved.companies, resolved.facts, limit=50), "companies").df
    more = further_values(resolved.facts, limit=50).where(F.col("kind") == LISTED_ID).groupBy("id").agg(F.count(F.lit(1)).alias("further"))
    scored = companies.select(
        "*",
        F.col("name_best").alias("name"),
        F.col("address").alias("address_raw"),
        F.lit("D").alias("segment"),
        F.lit(0).alias("crm_score"),
        F.lit(False).alias("is_network"),
        F.lit("unknown").alias("cms"),
        F.lit(False).alias("has_marquiz"),
    )
    path = scratch_path(spark, "large")
    write_csv(scored, path)
    written = read_csv(spark, path).groupBy(F.col("id").cast("long").alias("id")).agg(F.count(F.lit(1)).cast("int").alias("csv_rows"))
    total = markdown_lines(scored).where(F.col("line").startswith(TOTAL_LINE)).first()["line"].removeprefix(TOTAL_LINE)
    counted = segment_histogram(scored).agg(F.sum("companies")).first()[0]
    joined = companies.select("id", "n_listings", F.size("merged_from").alias("listed")).join(more, "id", "left").join(written, "id", "left")
    totals = {"markdown_total": F.lit(int(total)).cast("long"), "segment_total": F.lit(counted).cast("long")}
    return joined.na.fill(0, ["further"]).withColumns(totals)


@register(
    "whole_lists",
    listing_sql(
        """
, entity AS (SELECT id, CASE WHEN id % 3 = 0 THEN (SELECT min(id) FROM listings WHERE id % 3 = 0) ELSE id END AS entity FROM listings),
found AS (
    SELECT entity AS id, 'phone' AS kind, phone AS value, min((p.id, pos)) AS seen FROM phone p JOIN entity USING (id) GROUP BY ALL
    UNION ALL SELECT entity, 'email', email, min((e.id, pos)) FROM email e JOIN entity USING (id) GROUP BY ALL
),
placed AS (SELECT id, kind, value, row_number() OVER (PARTITION BY id, kind ORDER BY seen, value) AS place FROM found)
SELECT id, kind, place, value, place > 50 AS beside FROM placed"""
    ),
)
def _(spark, folder):
    """A third of all listings on one host: every phone and e-mail of a company, read back from a CSV report of 50 a row and the files beside it."""
    hosts = F.when(F.col("id") % 3 == 0, F.concat(F.lit("https://portal.example.ru/"), F.col("id").cast("string")))
    resolved = resolve_entities(listings(spark, folder).withColumns({"website": hosts, "city": F.lit("all")}), keys=("site",))
    blank = F.lit(None).cast("string")
    shown = {"name": F.col("name_best"), "address_raw": F.col("address"), "segment": blank, "cms": blank}
    plain = {"crm_score": F.lit(0), "is_network": F.lit(False), "has_marquiz": F.lit(False)}
    scored = keep(nest(resolved.companies, resolved.facts, limit=50).withColumns(shown | plain), "scored").df
    path = scratch_path(spark, "whole")
    write_csv(scored, path)
    write_further(further_rows(scored, resolved.facts, limit=50), path, (PHONE, EMAIL))
    rows = read_csv(spark, path).withColumn("id", F.col("id").cast("long"))
    kinds = [
        rows.where(f"{column} != ''").select("id", F.lit(kind).alias("kind"), F.posexplode(F.split(column, "; ")).alias("at", "value"))
        for kind, column in ((PHONE, "phones"), (EMAIL, "emails"))
    ]
    listed = kinds[0].unionByName(kinds[1]).select("id", "kind", (F.col("at") + 1).cast("long").alias("place"), "value", F.lit(False).alias("beside"))
    return listed.unionByName(read_further(spark, path).select("id", "kind", "place", "value", F.lit(True).alias("beside")))


TITLES = """('  "' || name || '", ' || id || ' ') AS title, CASE WHEN id % 2 = 0 THEN '東京' ELSE '大阪' END AS town"""


@register(
    "exported_csv",
    listing_sql(
        f"""
, titled AS (SELECT *, {TITLES} FROM scored)
SELECT town AS city, id::VARCHAR AS id, CASE WHEN town = '東京' THEN title || 'again' ELSE title END AS name, address_raw AS address,
       replace(phone_text, ';', '; ') AS phones, segment, crm_score::VARCHAR AS crm_score,
       row_number() OVER (PARTITION BY town ORDER BY crm_score DESC, id) AS place FROM titled""",
        NETWORK,
        SCORED,
    ),
)
def _(spark, folder):
    """Names with quotes, commas and outer blanks, in cities without Latin letters; one city is exported a second time."""
    title = F.concat(F.lit('  "'), F.col("name"), F.lit('", '), F.col("id").cast("string"), F.lit(" "))
    town = F.when(F.col("id") % 2 == 0, "東京").otherwise("大阪")
    scored = scored_listings(spark, folder).withColumns({"name": title, "city": town})
    path = scratch_path(spark, "csv")
    write_csv(scored, path)
    write_csv(scored.where("city = '東京'").withColumn("name", F.concat("name", F.lit("again"))), path)
    rows = read_csv(spark, path).withColumns({"file": F.col("_metadata.file_name"), "line": F.monotonically_increasing_id()})
    place = F.row_number().over(Window.partitionBy("city").orderBy("file", "line"))
    blank = F.lit("")
    texts = [F.coalesce(c, blank).alias(c) for c in ("name", "address", "phones")]
    return rows.select("city", "id", *texts, "segment", "crm_score", place.cast("long").alias("place"))


@register("scanned_scope", listing_sql("SELECT id, city, name FROM listings WHERE city = 'NATION_7'"))
def _(spark, folder):
    """One city of a table kept by city."""
    target = scratch_path(spark, "by-city")
    append_listings(listings(spark, folder).select("id", "city", "name"), target)
    return read_scope(spark, target, "NATION_7").select("id", "city", "name")


RUN_ROWS = """
SELECT id, city, name, replace(phones, ';', '; ') AS phones, coalesce(website, '') AS website, replace(emails, ';', '; ') AS emails,
       CASE WHEN crm_score >= 50 THEN 'A' WHEN crm_score >= 30 THEN 'B' WHEN crm_score >= 15 THEN 'C' ELSE 'D' END AS segment,
       crm_score::VARCHAR AS crm_score, cms FROM valued"""


@register("workspace_run", listing_sql(RUN_ROWS, COMPONENTS, MERGED, SHOPS, SCANNED, WHOLE_RUN).replace(*SHOP_LISTINGS))
def _(spark, folder):
    """Listing files and stored inputs to exported reports, through the commands; the files are read back."""
    root = scratch_path(spark, "workspace")
    base = dealt_listings(spark, folder)
    shop = F.concat(derived_pages.shop_site(F.col("id")), F.lit("/"))
    rows = base.withColumn("website", F.when(F.col("id") % 3 == 1, shop).otherwise(F.col("website")))
    unique = rows.withColumn("source_url", F.concat(F.lit("https://u/"), F.col("id").cast("string")))
    as_files(unique).write.parquet(f"{root}/incoming")
    hits = search_results(derived_pages.search_answers(rows), 3).withColumnRenamed("name", "query_name")
    ranked = hits.groupBy("city", "query_name", "pos").agg(F.min_by(F.struct("url", "title"), "id").alias("hit"))
    inputs = {
        "pages": derived_pages.shop_pages(base),
        "profiles": derived_pages.profiles(base),
        "hits": ranked.select("city", "query_name", "pos", "hit.url", "hit.title"),
        "details": sites(spark, folder).drop("id").withColumnRenamed("website", "url"),
    }
    for name, df in inputs.items():
        df.write.parquet(f"{root}/{name}")
    work = Workspace(spark, root, Rules(rank_titles=True))
    work.run(export=True)
    found = read_csv(spark, f"{root}/export/enriched")
    texts = [F.coalesce(c, F.lit("")).alias(c) for c in ("phones", "website", "emails")]
    return found.select(F.col("id").cast("long").alias("id"), "city", "name", *texts, "segment", "crm_score", "cms")
