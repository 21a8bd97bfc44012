"""The whole way from raw listings to scored companies and reports, for all cities in one run."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.html import add_missing_keys
from rollcall.functions.urls import clean_website, site_root
from rollcall.operators.gaps import best_hits, fill_gaps, missing_contacts, one_per_page, only_new
from rollcall.operators.merge import LISTING, PHONE, extend_entities, fact_counts, nest, resolve_entities, unnest
from rollcall.operators.network import flag_networks
from rollcall.operators.picking import first_per_key
from rollcall.operators.scoring import score_companies
from rollcall.operators.site_scan import found_handles, profile_table, scan_sites, visit_details
from rollcall.scratch import keep
from rollcall.settings import LEVELS, NETWORK_SIZE, WEIGHTS
from rollcall.sinks.reports import export_all


@dataclass(frozen=True)
class Rules:
    """What a run may vary. ``rank_titles`` prefers search hits whose title names the company to the first hit.

    ``listed`` is how many values of a kind stand in a company's row, by default all; exports write the others beside their reports.
    """

    scope: tuple[str, ...] = ("city",)
    weights: dict = field(default_factory=lambda: dict(WEIGHTS))
    levels: dict = field(default_factory=lambda: dict(LEVELS))
    network_size: int = NETWORK_SIZE
    rank_titles: bool = False
    listed: int | None = None


@dataclass(frozen=True)
class Finished:
    """What a run ends with: plain company rows, all their phones, e-mails and listing ids, and the list form of both."""

    scored: DataFrame
    facts: DataFrame
    listed: int | None = None

    @cached_property
    def companies(self) -> DataFrame:
        return nest(self.scored, self.facts, self.listed)


def enrich_companies(companies: DataFrame, pages: DataFrame, profiles: DataFrame) -> DataFrame:
    """Companies with clean website, messengers, builder and profile trust from stored pages and profiles."""
    cleaned = companies.withColumn("website", clean_website(F.col("website"))).withColumn("site", site_root(F.col("website")))
    scanned = scan_sites(cleaned.where("site is not null").select("site"), pages).withColumnRenamed("messengers", "found")
    on_site = cleaned.join(scanned, "site", "left")
    linked = on_site.withColumn("messengers", add_missing_keys(F.col("messengers"), F.col("found"))).drop("found", "site")
    seen = keep(linked, "linked").df
    silent = seen.where(~F.map_contains_key("messengers", "telegram")).select("id", F.col("name_best").alias("name"), "phone")
    handles = found_handles(silent, profiles).select("id", F.col("url").alias("handle"))
    addressed = seen.join(handles, "id", "left").withColumn(
        "messengers",
        F.when(F.col("handle").isNull(), F.col("messengers")).otherwise(
            F.map_concat("messengers", F.create_map(F.lit("telegram"), F.col("handle")))
        ),
    )
    trusted = profile_table(profiles).withColumnRenamed("url", "profile")
    return (
        addressed.withColumn("profile", F.try_element_at("messengers", F.lit("telegram")))
        .join(trusted, "profile", "left")
        .select(
            "id",
            "city",
            F.col("name_best").alias("name"),
            F.col("address").alias("address_raw"),
            "website",
            "n_phones",
            "n_emails",
            "phone",
            "messengers",
            "tg_trust",
            F.coalesce("cms", F.lit("unknown")).alias("cms"),
            F.coalesce("has_marquiz", F.lit(False)).alias("has_marquiz"),
            F.lit(False).alias("is_network"),
            "needs_review",
            "review_reason",
        )
    )


def finish(enriched: DataFrame, facts: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Networks, scores and segments, always computed afresh."""
    phones = facts.where(F.col("kind") == PHONE).select("id", F.col("value").alias("phone"))
    scoped = enriched.select(*rules.scope, "id").join(phones, "id")
    flagged = flag_networks(enriched, rules.scope, rules.network_size, phones=scoped)
    return score_companies(flagged, rules.weights, rules.levels)


def _known_companies(companies: DataFrame, prior: DataFrame) -> DataFrame:
    """Companies that were enriched before: merged values are new, what a visit found is kept."""
    kept = ["tg_trust", "cms", "has_marquiz"]
    stored = prior.select("id", F.col("website").alias("had_site"), F.col("messengers").alias("had_links"), *kept)
    return companies.join(stored, "id").select(
        "id",
        "city",
        F.col("name_best").alias("name"),
        F.col("address").alias("address_raw"),
        F.coalesce(clean_website(F.col("website")), "had_site").alias("website"),
        "n_phones",
        "n_emails",
        "phone",
        add_missing_keys(F.col("messengers"), F.col("had_links")).alias("messengers"),
        *kept,
        F.lit(False).alias("is_network"),
        "needs_review",
        "review_reason",
    )


def _with_counts(companies: DataFrame, facts: DataFrame) -> DataFrame:
    plain = companies.drop("n_phones", "n_emails", "phone")
    return plain.join(fact_counts(facts), "id", "left").na.fill(0, ["n_phones", "n_emails"])


def run(
    listings: DataFrame,
    pages: DataFrame,
    profiles: DataFrame,
    hits: DataFrame,
    details: DataFrame,
    already: DataFrame | None = None,
    rules: Rules = Rules(),
    already_facts: DataFrame | None = None,
    fetched: DataFrame | None = None,
    on_resolved: Callable[[DataFrame, DataFrame], None] | None = None,
    grouped: DataFrame | None = None,
) -> Finished:
    """Scored companies of all listings with their facts.

    ``hits`` is (city, query_name, pos, url, title): search answers per company name and city. ``details`` is
    (url, emails, phones, messengers, cms). ``already`` holds companies of an earlier run: they get the merged
    values of new listings and keep what was found for them, and only the others are visited and searched for. Their
    contacts are ``already_facts``, by default those of their lists. ``fetched`` (url, output) are texts of found pages,
    whose sites are visited among ``pages`` as well. ``on_resolved`` is called with the labelled listings and the
    companies before anything is visited.
    A company of an earlier run that has become part of another one passes its findings on. ``grouped`` are labelled
    listings of an earlier run by the same scope: only listings they lack are grouped, with the companies they touch.
    """
    resolved = resolve_entities(listings, rules.scope) if grouped is None else extend_entities(grouped, listings, rules.scope)
    companies = keep(resolved.companies, "companies").df
    facts = resolved.facts
    if on_resolved is not None:
        on_resolved(resolved.labelled, companies)
    if fetched is not None:
        details = details.unionByName(visit_details(fetched, pages))
    prior = None
    if already is not None:
        roots = resolved.labelled.select("id", "entity")
        mapped = already.join(roots, "id")
        prior = first_per_key(mapped, ["entity"], "id").drop("id").withColumnRenamed("entity", "id")
        known = unnest(already) if already_facts is None else already_facts.join(already.select("id"), "id", "left_semi")
        found = known.where(F.col("kind") != LISTING).select("id", "kind", "value").join(roots, "id")
        extra = found.select(F.col("entity").alias("id"), "kind", "value").distinct().join(facts, ["id", "kind", "value"], "left_anti")
        late = extra.select("id", "kind", "value", F.lit(2**62).alias("first_id"), F.lit(0).alias("pos"))
        facts = keep(facts.unionByName(late), "facts").df
    new = companies if prior is None else only_new(companies, prior)
    enriched = keep(enrich_companies(new, pages, profiles), "enriched").df
    open_companies = missing_contacts(enriched)
    own_hits = hits.withColumnRenamed("query_name", "name").join(open_companies.select("id", "name", "city"), ["name", "city"])
    chosen = best_hits(open_companies, own_hits.select("id", "pos", "url", "title"), rules.rank_titles)
    filled = fill_gaps(enriched, facts, chosen.join(one_per_page(details), "url"))
    together = filled.companies
    if prior is not None:
        known = _with_counts(_known_companies(companies, prior), facts)
        together = together.unionByName(known)
    return Finished(keep(finish(together, filled.facts, rules), "scored").df, filled.facts, rules.listed)


def refill(enriched: DataFrame, hits: DataFrame, details: DataFrame, rules: Rules = Rules(), facts: DataFrame | None = None) -> Finished:
    """Fills the gaps of companies that are enriched already and scores them again.

    Their contacts are ``facts``, by default those of their lists.
    """
    facts = keep(unnest(enriched), "known-facts").df if facts is None else facts
    counted = _with_counts(enriched.drop("phones", "emails", "merged_from"), facts)
    open_companies = missing_contacts(counted)
    chosen = best_hits(open_companies, hits, rank_titles=True)
    filled = fill_gaps(counted, facts, chosen.join(one_per_page(details), "url"))
    return Finished(keep(finish(filled.companies, filled.facts, rules), "scored").df, filled.facts, rules.listed)


def publish(scored: DataFrame, folder: str, presets: dict | None = None) -> dict[str, str]:
    stored = keep(scored, "export").df
    return export_all(stored, folder) if presets is None else export_all(stored, folder, presets)
