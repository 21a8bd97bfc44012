"""Finding and filling companies without a website or an e-mail."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.functions.html import add_missing_keys
from rollcall.functions.phones import normalize_phone, strip_separators
from rollcall.operators.merge import EMAIL, PHONE
from rollcall.operators.picking import first_per_key
from rollcall.schema import no_messengers
from rollcall.scratch import keep


def lacks_contacts(df: DataFrame) -> Column:
    """No website, or no e-mail."""
    emails = F.col("n_emails") if "n_emails" in df.columns else F.size("emails")
    return (F.coalesce(F.col("website"), F.lit("")) == "") | (F.coalesce(emails, F.lit(0)) <= 0)


def missing_contacts(companies: DataFrame) -> DataFrame:
    return companies.where(lacks_contacts(companies))


def only_new(companies: DataFrame, enriched: DataFrame) -> DataFrame:
    """Companies without an enriched row yet."""
    return companies.join(enriched.select("id"), "id", "left_anti")


def title_names_company(title: Column, name: Column) -> Column:
    """Whether a title holds one of the first three words of the name that are longer than two letters."""
    words = F.filter(
        F.slice(F.filter(F.split(F.lower(name), r"\s+"), lambda w: w != ""), 1, 3), lambda w: F.length(w) > 2
    )
    return F.exists(words, lambda w: F.contains(F.lower(F.coalesce(title, F.lit(""))), w))


def best_hits(companies: DataFrame, hits: DataFrame, rank_titles: bool = True) -> DataFrame:
    """(id, url): per company the first hit whose title names it, else the first hit.

    ``hits`` holds (id, pos, url, title). A chosen first hit without an address gives no row.
    """
    named = hits.join(companies.select("id", F.col("name")), "id")
    has_url = F.coalesce(F.col("url"), F.lit("")) != ""
    fits = F.coalesce(has_url & title_names_company(F.col("title"), F.col("name")), F.lit(False))
    ranked = named.select("id", "pos", "url", (F.when(fits, 0).otherwise(1) if rank_titles else F.lit(1)).alias("rank"))
    return first_per_key(ranked, ["id"], "rank", "pos").where("url != ''").select("id", "url")


def one_per_page(details: DataFrame) -> DataFrame:
    """One row of details per address, for pages that were fetched again: the one with most values, then the first as text."""
    values = [F.coalesce(F.size(f.name), F.lit(0)) for f in details.schema.fields if isinstance(f.dataType, T.ArrayType | T.MapType)]
    shown = [F.sort_array(F.map_entries(f.name)).alias(f.name) if isinstance(f.dataType, T.MapType) else F.col(f.name) for f in details.schema.fields]
    return first_per_key(details.where("url IS NOT NULL"), ["url"], -reduce(Column.__add__, values, F.lit(0)), F.to_json(F.struct(*shown)))


@dataclass(frozen=True)
class Filled:
    """Companies after the fill, their contacts, and one row per added value."""

    companies: DataFrame
    facts: DataFrame
    added: DataFrame


def fill_gaps(companies: DataFrame, facts: DataFrame, details: DataFrame, literal: bool = False) -> Filled:
    """Fills companies that lack a website or an e-mail from page details.

    ``details`` holds one row per company: (id, url, emails, phones, messengers, cms). A website fills only a
    gap, e-mails and phones are added, messengers fill missing kinds, a builder only an unknown one. Contacts
    are compared in long form on (id, kind, value), so a company with many of them is spread over all tasks.
    The added contacts are written to scratch once. ``literal`` keeps the leading ``+`` of added phones.
    """
    open_companies = companies.where(lacks_contacts(companies))
    found = open_companies.select("id").join(details, "id")
    phone = strip_separators(F.col("value")) if literal else normalize_phone(F.col("value"))
    offered = (
        found.select("id", F.lit(EMAIL).alias("kind"), F.posexplode("emails").alias("pos", "value"))
        .unionByName(
            found.select("id", F.lit(PHONE).alias("kind"), F.posexplode("phones").alias("pos", "value")).withColumn(
                "value", phone
            )
        )
        .where("value != ''")
        .groupBy("id", "kind", "value")
        .agg(F.min("pos").alias("pos"))
    )
    fresh = keep(
        offered.join(facts.select("id", "kind", "value"), ["id", "kind", "value"], "left_anti").select(
            "id", "kind", "value", F.lit(2**62).alias("first_id"), "pos"
        ),
        "fresh",
    ).df
    grown = fresh.groupBy("id").agg(
        F.count_if(F.col("kind") == PHONE).cast("int").alias("more_phones"),
        F.count_if(F.col("kind") == EMAIL).cast("int").alias("more_emails"),
    )
    seen = found.select("id", "url", F.col("messengers").alias("seen_messengers"), F.col("cms").alias("seen_cms"))
    joined = companies.join(seen, "id", "left")
    was_open = F.col("url").isNotNull()
    no_site = was_open & (F.coalesce("website", F.lit("")) == "")
    unknown = F.coalesce(F.nullif("cms", F.lit("")), F.lit("unknown")) == "unknown"
    new_cms = was_open & unknown & (F.coalesce("seen_cms", F.lit("unknown")) != "unknown")
    new_kinds = F.map_keys(
        F.map_filter(
            F.coalesce("seen_messengers", no_messengers()),
            lambda k, v: ~F.map_contains_key(F.coalesce("messengers", no_messengers()), k),
        )
    )
    plain = F.concat(
        F.when(no_site, F.array(F.lit("website"))).otherwise(F.array().cast("array<string>")),
        new_kinds,
        F.when(new_cms, F.array(F.concat(F.lit("cms:"), "seen_cms"))).otherwise(F.array().cast("array<string>")),
    )
    added = joined.select("id", F.explode(plain).alias("field")).unionByName(
        fresh.select("id", F.col("kind").alias("field"))
    )
    counters = {
        name: (F.col(name) + F.coalesce(more, F.lit(0))).cast("int").alias(name)
        for name, more in (("n_phones", "more_phones"), ("n_emails", "more_emails"))
        if name in companies.columns
    }
    changed = {
        "website": F.when(no_site, F.col("url")).otherwise(F.col("website")).alias("website"),
        "messengers": add_missing_keys(F.col("messengers"), F.col("seen_messengers")).alias("messengers"),
        "cms": F.when(new_cms, F.col("seen_cms")).otherwise(F.col("cms")).alias("cms"),
        **counters,
    }
    filled = joined.join(grown, "id", "left").select(*[changed.get(c, F.col(c)) for c in companies.columns])
    return Filled(filled, facts.unionByName(fresh.select(*facts.columns)), added)


def fill_statistics(filled: Filled, attempted: DataFrame) -> DataFrame:
    """Per added field the number of values and companies, and one ``improved`` and ``attempted`` row."""
    field = F.when(F.startswith("field", F.lit("cms:")), F.lit("cms")).otherwise(F.col("field"))
    per_field = (
        filled.added.select("id", field.alias("field"))
        .groupBy("field")
        .agg(F.count(F.lit(1)).alias("values_added"), F.countDistinct("id").alias("companies"))
    )
    improved = filled.added.agg(
        F.lit("improved").alias("field"),
        F.count(F.lit(1)).alias("values_added"),
        F.countDistinct("id").alias("companies"),
    )
    tried = attempted.agg(
        F.lit("attempted").alias("field"), F.lit(0).cast("long").alias("values_added"), F.count(F.lit(1)).alias("companies")
    )
    return per_field.unionByName(improved).unionByName(tried)
