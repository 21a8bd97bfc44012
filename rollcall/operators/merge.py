"""One company per group of listings.

A group may hold any share of the data (every shop on one portal host), so a company
is kept as a row of plain values plus long tables of its phones, e-mails and listing
ids. Plain values come from aggregates with constant-size buffers. ``nest`` builds
one row per company, with lists of all values: long ones are sorted in pieces by many tasks.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.texts import blank_to_null, street_of
from rollcall.operators.linkage import (
    SCOPE,
    clean_contacts,
    column_or_null,
    connected_components,
    phone_links,
    site_links,
    star_edges,
    with_component,
)
from rollcall.operators.picking import numbered
from rollcall.schema import MESSENGERS, STRINGS, no_messengers, no_strings
from rollcall.scratch import keep

# Fixed value: reason given for a company whose listings name several streets.
STREET_CONFLICT = "same_name_diff_address"

PHONE, EMAIL, LISTING = "phone", "email", "listing"

#: Values of a kind that are sorted at once for the row of a company; longer lists are put together from sorted pieces.
PIECE = 10_000


@dataclass(frozen=True)
class Resolved:
    """Labelled listings, and the tables derived from them."""

    labelled: DataFrame
    scope: tuple[str, ...] = SCOPE

    @cached_property
    def facts(self) -> DataFrame:
        """(id, kind, value, first_id, pos): each phone, e-mail and listing id of a company, once. Stored."""
        return keep(company_facts(self.labelled), "facts").df

    @property
    def companies(self) -> DataFrame:
        return merge_companies(self.labelled, self.facts, self.scope)

    @property
    def members(self) -> DataFrame:
        return self.labelled.select(F.col("entity").alias("id"), F.col("id").alias("listing_id"))


def _longest(name: str) -> Column:
    """Longest value of a group, of the lowest id on ties, null when all are null."""
    value = F.col(name)
    return F.max_by(value, F.when(value.isNotNull(), F.struct(F.length(value).alias("n"), (-F.col("id")).alias("i"))))


def company_messengers(labelled: DataFrame) -> DataFrame:
    """(id, messengers): per messenger the link of the lowest listing id that has one.

    A map holds one entry per kind of messenger, not per listing.
    """
    links = labelled.select("entity", "id", F.explode("messengers").alias("kind", "link")).where("link != ''")
    firsts = links.groupBy("entity", "kind").agg(F.min_by("link", "id").alias("link"))
    return firsts.groupBy(F.col("entity").alias("id")).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("kind", "link")))).alias("messengers")
    )


def company_facts(labelled: DataFrame) -> DataFrame:
    def values(kind: str, column: str) -> DataFrame:
        return labelled.select(
            "entity", "id", F.lit(kind).alias("kind"), F.posexplode(F.col(column)).alias("pos", "value")
        ).where("value != ''")

    contacts = (
        values(PHONE, "phones")
        .unionByName(values(EMAIL, "emails"))
        .groupBy("entity", "kind", "value")
        .agg(F.min("id").alias("first_id"), F.min_by("pos", "id").alias("pos"))
    )
    listed = labelled.select(
        "entity",
        F.lit(LISTING).alias("kind"),
        F.col("id").cast("string").alias("value"),
        F.col("id").alias("first_id"),
        F.lit(0).alias("pos"),
    )
    columns = [F.col("entity").alias("id"), "kind", "value", "first_id", "pos"]
    return contacts.unionByName(listed).select(*columns)


def fact_counts(facts: DataFrame) -> DataFrame:
    """(id, n_phones, n_emails, phone): distinct contacts of a company and its first phone."""
    is_phone = F.col("kind") == PHONE
    rank = F.when(is_phone, F.struct("first_id", "pos"))
    return (
        facts.where(F.col("kind") != LISTING)
        .groupBy("id")
        .agg(
            F.count_if(is_phone).cast("int").alias("n_phones"),
            F.count_if(F.col("kind") == EMAIL).cast("int").alias("n_emails"),
            F.min_by("value", rank).alias("phone"),
        )
    )


def merge_companies(labelled: DataFrame, facts: DataFrame, scope: tuple[str, ...] = SCOPE) -> DataFrame:
    """One row per group: longest name, address and website, counts, messengers, conflict flag."""
    values = labelled.select(
        "entity",
        "id",
        *scope,
        *[blank_to_null(F.col(c)).alias(c) for c in ("name", "address_raw", "website")],
        F.nullif(street_of(F.col("address_raw")), F.lit("")).alias("street"),
    )
    plain = values.groupBy(F.col("entity").alias("id")).agg(
        *[F.min_by(c, "id").alias(c) for c in scope],
        F.coalesce(_longest("name"), F.lit("")).alias("name_best"),
        F.coalesce(_longest("address_raw"), F.lit("")).alias("address"),
        _longest("website").alias("website"),
        F.count(F.lit(1)).alias("n_listings"),
        F.coalesce(F.min("street") != F.max("street"), F.lit(False)).alias("needs_review"),
    )
    return (
        plain.join(fact_counts(facts), "id", "left")
        .join(company_messengers(labelled), "id", "left")
        .select(
            "id",
            *scope,
            "name_best",
            "address",
            "website",
            "n_listings",
            F.coalesce("n_phones", F.lit(0)).alias("n_phones"),
            F.coalesce("n_emails", F.lit(0)).alias("n_emails"),
            "phone",
            F.coalesce("messengers", no_messengers()).cast(MESSENGERS).alias("messengers"),
            F.lit("raw").alias("status"),
            "needs_review",
            F.when(F.col("needs_review"), F.lit(STREET_CONFLICT)).otherwise(F.lit("")).alias("review_reason"),
        )
    )


def resolve_entities(
    listings: DataFrame,
    scope: tuple[str, ...] = SCOPE,
    keys: tuple[str, ...] = ("phone", "site"),
    extra_edges: DataFrame | None = None,
    country: str = "7",
    trunk: str = "8",
    literal: bool = False,
    shared_hosts: tuple[str, ...] = (),
) -> Resolved:
    """Groups listings that share a phone or a website host, transitively, within each scope.

    ``extra_edges`` (hi, lo), for example of similar names, join the same grouping.
    Links and labelled listings are written to scratch once each; what follows reads them from there.
    """
    cleaned = clean_contacts(listings, country, trunk)
    stored = keep(_links(cleaned, scope, keys, literal, shared_hosts), "links")
    stars = star_edges(stored.df, scope)
    roots = connected_components(stars if extra_edges is None else stars.unionByName(extra_edges))
    stored.drop()
    kept = keep(_labelled(cleaned, roots.df, scope), "labelled")
    roots.drop()
    return Resolved(kept.df, scope)


def _links(listings: DataFrame, scope: tuple[str, ...], keys: tuple[str, ...], literal: bool, shared_hosts: tuple[str, ...]) -> DataFrame:
    links = []
    if "phone" in keys:
        links.append(phone_links(listings, scope))
    if "site" in keys:
        links.append(site_links(listings, scope, literal, shared_hosts))
    return reduce(DataFrame.unionByName, links)


def _labelled(cleaned: DataFrame, roots: DataFrame, scope: tuple[str, ...]) -> DataFrame:
    return with_component(cleaned, roots).select(
        "entity",
        "id",
        *scope,
        column_or_null(cleaned, "source").alias("source"),
        "name",
        "phones",
        "address_raw",
        "website",
        "emails",
        F.coalesce("messengers", no_messengers()).alias("messengers"),
    )


def extended_links(
    labelled: DataFrame,
    cleaned: DataFrame,
    scope: tuple[str, ...] = SCOPE,
    keys: tuple[str, ...] = ("phone", "site"),
    literal: bool = False,
    shared_hosts: tuple[str, ...] = (),
) -> DataFrame:
    """(scope, key, id) of new listings, and of the companies that hold a key of theirs: a company is one node, its id.

    All holders of a key are in one company already, so the companies add at most one row per key of the new listings.
    """
    fresh = _links(cleaned, scope, keys, literal, shared_hosts)
    held = _links(labelled.withColumn("id", F.col("entity")), scope, keys, literal, shared_hosts)
    asked = fresh.select(*scope, "key").distinct()
    return fresh.unionByName(held.join(asked, [*scope, "key"], "left_semi").distinct())


def extend_entities(
    labelled: DataFrame,
    listings: DataFrame,
    scope: tuple[str, ...] = SCOPE,
    keys: tuple[str, ...] = ("phone", "site"),
    country: str = "7",
    trunk: str = "8",
    literal: bool = False,
    shared_hosts: tuple[str, ...] = (),
) -> Resolved:
    """The grouping of an earlier run with further listings, equal to grouping all of them at once with the same settings.

    ``labelled`` is what ``resolve_entities`` or this function gave before; those of ``listings`` whose id it holds are left
    out. Stored listings are neither cleaned nor linked again: the graph has the new listings and the stored companies that
    share a key with one, so its size is that of the new listings. Companies that a new listing joins become one. The
    companies to relabel are few, so their ids travel to the stored rows and not the reverse.
    """
    cleaned = keep(clean_contacts(listings.join(labelled.select("id"), "id", "left_anti"), country, trunk), "fresh")
    stored = keep(extended_links(labelled, cleaned.df, scope, keys, literal, shared_hosts), "links")
    roots = connected_components(star_edges(stored.df, scope))
    stored.drop()
    moved = roots.df.select(F.col("id").alias("entity"), "root")
    columns = _labelled(cleaned.df, roots.df, scope)
    kept_as = labelled.join(moved, "entity", "left").withColumn("entity", F.coalesce("root", "entity")).select(*columns.columns)
    kept = keep(kept_as.unionByName(columns), "labelled")
    for table in (roots, cleaned):
        table.drop()
    return Resolved(kept.df, scope)


def _long_kinds(facts: DataFrame, limit: int) -> DataFrame:
    """(id, kind): kinds of a company with more values than its lists hold."""
    return facts.groupBy("id", "kind").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit).select("id", "kind")


def _placed(facts: DataFrame, kinds: DataFrame) -> DataFrame:
    """The facts of some kinds with their ``place`` from 1 in first-seen order."""
    return numbered(facts.join(kinds, ["id", "kind"], "left_semi"), ["id", "kind"], ["first_id", "pos", "value"], "place")


def first_values(facts: DataFrame, limit: int) -> DataFrame:
    """The facts that fit into lists of ``limit`` values: the first ones of each kind.

    Only kinds of a company with more values are put in order; the others are taken as they are.
    """
    sizes = _long_kinds(facts, limit)
    large = _placed(facts, sizes)
    return facts.join(sizes, ["id", "kind"], "left_anti").unionByName(large.where(F.col("place") <= limit).drop("place"))


def further_values(facts: DataFrame, limit: int | None = None) -> DataFrame:
    """The facts that do not, with their ``place``: values of a kind after the first ``limit`` of a company. None without a limit."""
    if limit is None:
        return facts.where(F.lit(False)).withColumn("place", F.lit(0).cast("long"))
    return _placed(facts, _long_kinds(facts, limit)).where(F.col("place") > limit)


def _pieces(facts: DataFrame, size: int) -> DataFrame:
    """(id, kind, piece): the facts as pieces (first_id, pos, values) that give, in order, all values of a kind in first-seen order.

    Kinds with up to ``size`` values have a piece for each; of the others each piece holds ``size`` values, sorted in a task of its own.
    """
    sizes = _long_kinds(facts, size)
    single = F.struct("first_id", "pos", F.array("value").alias("values"))
    short = facts.join(sizes, ["id", "kind"], "left_anti").select("id", "kind", single.alias("piece"))
    number = F.call_function("div", F.col("place") - 1, F.lit(size))
    ordered = (
        _placed(facts, sizes)
        .groupBy("id", "kind", number.alias("number"))
        .agg(F.array_sort(F.collect_list(F.struct("first_id", "pos", "value"))).alias("entries"))
    )
    whole = F.struct(F.col("entries")[0]["first_id"].alias("first_id"), F.col("entries")[0]["pos"].alias("pos"), F.col("entries")["value"].alias("values"))
    return short.unionByName(ordered.select("id", "kind", whole.alias("piece")))


def nest(companies: DataFrame, facts: DataFrame, limit: int | None = None) -> DataFrame:
    """Companies with lists: ``phones``, ``emails`` and ``merged_from`` in first-seen order, one row per company.

    The lists hold all values. With a ``limit`` they hold the first so many of each kind, and ``further_values`` has the rest;
    ``n_phones``, ``n_emails`` and ``n_listings`` count all values either way.
    """

    def listed(kind: str) -> Column:
        pieces = F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.col("piece"))))
        return F.flatten(F.transform(pieces, lambda p: p["values"]))

    lists = _pieces(facts if limit is None else first_values(facts, limit), PIECE).groupBy("id").agg(
        listed(PHONE).alias("phones"),
        listed(EMAIL).alias("emails"),
        F.transform(listed(LISTING), lambda v: v.cast("long")).alias("merged_from"),
    )
    return companies.join(lists, "id", "left").withColumns(
        {"phones": F.coalesce("phones", no_strings()).cast(STRINGS), "emails": F.coalesce("emails", no_strings()).cast(STRINGS)}
    )


def unnest(rows: DataFrame) -> DataFrame:
    """Facts of rows that carry ``phones`` and ``emails`` lists, and ``merged_from`` where there is one."""

    def values(kind: str, column: str) -> DataFrame:
        distinct = F.array_distinct(F.col(column))
        return rows.select("id", F.lit(kind).alias("kind"), F.posexplode(distinct).alias("pos", "value"))

    contacts = (
        values(PHONE, "phones")
        .unionByName(values(EMAIL, "emails"))
        .where("value != ''")
        .select("id", "kind", "value", F.col("id").alias("first_id"), "pos")
    )
    if "merged_from" not in rows.columns:
        return contacts
    listed = rows.select("id", F.explode("merged_from").alias("first_id"))
    return contacts.unionByName(
        listed.select("id", F.lit(LISTING).alias("kind"), F.col("first_id").cast("string").alias("value"), "first_id", F.lit(0).alias("pos"))
    )
