"""What a visit to a company's stored pages finds: messengers, builder, profile trust, handles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.handles import candidate_handles
from rollcall.functions.html import (
    add_missing_keys,
    cms_of,
    contact_href,
    has_quiz,
    links_on_site,
    profile_exists,
    profile_is_relevant,
    profile_trust,
    relevant_hrefs,
    social_links,
)
from rollcall.functions.urls import clean_website, resolve_link, site_root
from rollcall.operators.picking import first_per_key
from rollcall.schema import MESSENGERS, no_messengers
from rollcall.scratch import keep
from rollcall.settings import RELEVANT_WORDS
from rollcall.sources.search import detail_rows


def _address(url: Column) -> Column:
    """Pages are found with or without the closing slash."""
    return site_root(F.substring_index(url, "#", 1))


def page_findings(pages: DataFrame, literal: bool = False) -> DataFrame:
    """(address, url, found, cms, has_marquiz, contact, relevant): what is read from each page that answered with status 200.

    One pass over the pages, written once: what is joined afterwards are these few values, never the pages.
    """
    html = F.col("html")
    reached = pages.where("status = 200") if "status" in pages.columns else pages
    read = reached.select(
        _address(F.col("url")).alias("address"),
        "url",
        social_links(html, literal).alias("found"),
        cms_of(html).alias("cms"),
        has_quiz(html).alias("has_marquiz"),
        contact_href(html).alias("contact"),
        relevant_hrefs(html).alias("relevant"),
    )
    return keep(read, "findings").df


def scan_sites(sites: DataFrame, pages: DataFrame, literal: bool = False) -> DataFrame:
    """(site, messengers, cms, has_marquiz) per distinct site that has a stored home page.

    Home page first. Without a Telegram link there, the contact page, and then up to three more pages linked
    from it until both Telegram and WhatsApp are known. Each site is scanned once however many companies share
    it, and each step is one join of the findings on the page address.
    """
    store = page_findings(pages, literal)
    home = first_per_key(
        sites.select("site")
        .distinct()
        .join(store, F.col("site") == F.col("address"))
        .select(
            "site",
            "url",
            F.col("found").alias("home_found"),
            resolve_link(F.concat("site", F.lit("/")), F.col("contact")).alias("contact_url"),
            "cms",
            "has_marquiz",
        ),
        ["site"],
        "url",
    ).drop("url")
    contacts = first_per_key(
        home.where(~F.map_contains_key("home_found", "telegram") & F.col("contact_url").isNotNull())
        .select("site", "home_found", "contact_url", _address(F.col("contact_url")).alias("address"))
        .join(store.drop("cms", "has_marquiz", "contact"), "address")
        .select(
            "site",
            "url",
            "contact_url",
            add_missing_keys(F.col("home_found"), F.col("found")).alias("known"),
            links_on_site(F.col("relevant"), F.col("site")).alias("links"),
        ),
        ["site"],
        "url",
    ).drop("url")
    extras = first_per_key(
        contacts.select("site", "contact_url", F.posexplode("links").alias("pos", "link"))
        .where("link != contact_url")
        .select("site", "pos", _address(F.col("link")).alias("address"))
        .join(store.select("address", "url", "found"), "address")
        .select("site", "pos", "url", "found"),
        ["site", "pos"],
        "url",
    )
    visits = extras.groupBy("site").agg(
        *[F.max(F.when(F.col("pos") == pos, F.struct("pos", F.map_entries("found").alias("links")))).alias(f"visit{pos}") for pos in range(3)]
    )
    known = F.col("known")
    for pos in range(3):
        done = F.map_contains_key(known, "telegram") & F.map_contains_key(known, "whatsapp")
        found = F.map_from_entries(F.col(f"visit{pos}.links"))
        known = F.when(done, known).otherwise(add_missing_keys(known, found))
    visited = contacts.join(visits, "site", "left").select("site", known.alias("found"))
    return home.join(visited, "site", "left").select(
        "site", F.coalesce("found", "home_found").cast(MESSENGERS).alias("messengers"), "cms", "has_marquiz"
    )


def visit_details(fetched: DataFrame, pages: DataFrame) -> DataFrame:
    """(url, emails, phones, messengers, cms) of fetched texts (url, output) and the stored pages of their sites."""
    texts = detail_rows(fetched).select("url", "emails", "phones", site_root(clean_website(F.col("url"))).alias("site"))
    scanned = scan_sites(texts.select("site").where("site is not null"), pages).select("site", "messengers", "cms")
    return texts.join(scanned, "site", "left").select(
        "url", "emails", "phones", F.coalesce("messengers", no_messengers()).alias("messengers"), F.coalesce("cms", F.lit("unknown")).alias("cms")
    )


def handle_candidates(companies: DataFrame) -> DataFrame:
    """(id, pos, handle): candidate profile names in order of preference; needs ``name`` and ``phone``."""
    options = candidate_handles(F.col("name"), F.col("phone"))
    return companies.select("id", F.posexplode(options).alias("pos", "handle"))


def verified_handles(
    candidates: DataFrame, profiles: DataFrame, words: tuple[str, ...] = RELEVANT_WORDS
) -> DataFrame:
    """(id, url): per company the first candidate whose stored profile page is relevant."""
    relevant = profiles.where(profile_is_relevant(F.col("html"), words)).select("url").distinct()
    addressed = candidates.withColumn("url", F.concat(F.lit("https://t.me/"), "handle"))
    return first_per_key(addressed.join(relevant, "url").select("id", "pos", "url"), ["id"], "pos").select("id", "url")


def phone_handles(companies: DataFrame, profiles: DataFrame) -> DataFrame:
    """(id, url) of companies whose first phone has a stored profile that exists; needs ``phone``."""
    existing = profiles.where(profile_exists(F.col("html"))).select("url").distinct()
    dialled = companies.where(F.length("phone") == 11).select("id", F.concat(F.lit("https://t.me/+"), "phone").alias("url"))
    return dialled.join(existing, "url", "left_semi")


def found_handles(companies: DataFrame, profiles: DataFrame) -> DataFrame:
    """(id, url): the profile of the phone, else the first relevant one of the names; needs ``name`` and ``phone``."""
    by_phone = phone_handles(companies, profiles)
    by_name = verified_handles(handle_candidates(companies), profiles)
    return by_phone.select("id", "url").unionByName(by_name.join(by_phone, "id", "left_anti").select("id", "url"))


def profile_table(profiles: DataFrame) -> DataFrame:
    """(url, tg_trust) per stored profile; of several copies the one with the most marks."""
    return profiles.select("url", profile_trust(F.col("html")).alias("tg_trust")).groupBy("url").agg(F.max("tg_trust").alias("tg_trust"))


def add_messengers(companies: DataFrame, found: DataFrame) -> DataFrame:
    """Adds messenger kinds a company lacks from (id, found) rows."""
    joined = companies.join(found.select("id", F.col("found")), "id", "left")
    merged = add_missing_keys(F.col("messengers"), F.coalesce("found", no_messengers()))
    return joined.withColumn("messengers", merged).select(*companies.columns)
