"""Links between listings that share a key, and the groups they form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.binding import rows_with
from rollcall.functions.emails import valid_emails
from rollcall.functions.phones import normalize_phones
from rollcall.functions.urls import domain_of
from rollcall.scratch import Kept, keep

SCOPE = ("city",)


def clean_contacts(listings: DataFrame, country: str = "7", trunk: str = "8") -> DataFrame:
    """Phones normalised and e-mails validated, both distinct in first-seen order."""
    return listings.withColumns(
        {"phones": normalize_phones(F.col("phones"), country, trunk), "emails": valid_emails(F.col("emails"))}
    )


def phone_links(listings: DataFrame, scope: tuple[str, ...] = SCOPE) -> DataFrame:
    """(scope, key, id) for every phone of every listing; phones are taken as they are.

    The outer form keeps Spark from adding a size test below, which would clean every list twice.
    """
    listed = listings.select(*scope, "id", F.explode_outer("phones").alias("phone")).where("phone is not null")
    return listed.select(*scope, F.concat(F.lit("p:"), "phone").alias("key"), "id")


def site_links(
    listings: DataFrame,
    scope: tuple[str, ...] = SCOPE,
    literal: bool = False,
    shared_hosts: tuple[str, ...] = (),
) -> DataFrame:
    """(scope, key, id) for every listing with a website. ``shared_hosts`` names portals that prove nothing."""
    keyed = listings.select(*scope, "id", rows_with(domain_of(F.col("website"), literal)).alias("domain"))
    if shared_hosts:
        keyed = keyed.where(~F.col("domain").isin(*shared_hosts))
    return keyed.select(*scope, F.concat(F.lit("s:"), "domain").alias("key"), "id")


def star_edges(links: DataFrame, scope: tuple[str, ...] = SCOPE) -> DataFrame:
    """One edge from every holder of a shared key to its lowest holder: linear in the links.

    The lowest id is a pre-aggregated minimum; the join back has one row per shared
    key on one side, which lets AQE split a hot key on the other.
    """
    keys = [*scope, "key"]
    centres = (
        links.groupBy(*keys).agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high").drop("high")
    )
    return (
        links.join(centres, keys)
        .where("id > low")
        .select(F.col("id").alias("hi"), F.col("low").alias("lo"))
        .distinct()
    )


def _parents(edges: DataFrame) -> DataFrame:
    return edges.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("parent"))


def _is_settled(edges: DataFrame) -> bool:
    """Stars only: every node hangs on one lower node, which hangs on nothing."""
    ends = F.array(F.struct(F.col("hi").alias("node"), F.lit(1).alias("above"), F.lit(0).alias("below")), F.struct(F.col("lo").alias("node"), F.lit(0).alias("above"), F.lit(1).alias("below")))
    placed = edges.select(F.inline(ends)).groupBy("node").agg(F.sum("above").alias("above"), F.max("below").alias("below"))
    return placed.where("above > 1 OR above = 1 AND below = 1").agg(F.count(F.lit(1))).first()[0] == 0


def _contract(edges: DataFrame) -> DataFrame:
    """One round: hang each node on its neighbours' lowest neighbour, then on its own lowest one."""
    parents = _parents(edges)
    lifted = (
        edges.join(parents, F.col("lo") == F.col("node"), "left")
        .select("hi", F.coalesce("parent", "lo").alias("lo"))
        .distinct()
    )
    lowest = _parents(lifted)
    moved = F.when(F.col("lo") == F.col("parent"), F.col("hi")).otherwise(F.col("lo"))
    return (
        lifted.join(lowest, F.col("hi") == F.col("node"))
        .select(moved.alias("hi"), F.col("parent").alias("lo"))
        .distinct()
    )


def connected_components(edges: DataFrame) -> Kept:
    """(id, root) for every node that is not the lowest of its component.

    Large-star / small-star contraction (Kiveris et al., SoCC 2014) on (hi, lo)
    pairs. Edges never grow in number, long chains halve from round to round, and
    each round is written to scratch, so neither the plan nor a lost executor
    reaches back further than one round.
    """
    oriented = edges.select(F.greatest("hi", "lo").alias("hi"), F.least("hi", "lo").alias("lo")).where("hi > lo").distinct()
    current = keep(oriented, "edges")
    while not _is_settled(current.df):
        following = keep(_contract(current.df), "edges")
        current.drop()
        current = following
    return Kept(current.df.select(F.col("hi").alias("id"), F.col("lo").alias("root")), current.path)


def with_component(listings: DataFrame, roots: DataFrame, name: str = "entity") -> DataFrame:
    """Listings with the id of their component, which is the lowest listing id in it."""
    joined = listings.join(roots, "id", "left")
    return joined.withColumn(name, F.coalesce("root", "id")).drop("root")


def clusters_by_key(listings: DataFrame, links: DataFrame, scope: tuple[str, ...] = SCOPE) -> DataFrame:
    """(scope, cluster, id) of all groups of two and more that hang together by the links."""
    stored = keep(links, "links")
    roots = connected_components(star_edges(stored.df, scope)).df
    stored.drop()
    members = roots.select(F.col("root").alias("cluster"), "id")
    lowest = members.select("cluster", F.col("cluster").alias("id")).distinct()
    return members.unionByName(lowest).join(listings.select("id", *scope), "id").select(*scope, "cluster", "id")


def shared_domains(listings: DataFrame, scope: tuple[str, ...] = SCOPE, literal: bool = False) -> DataFrame:
    """(scope, domain, cluster, id): listings of each domain that two or more share, not chained further."""
    keyed = listings.select(*scope, "id", rows_with(domain_of(F.col("website"), literal)).alias("domain"))
    keys = [*scope, "domain"]
    shared = (
        keyed.groupBy(*keys)
        .agg(F.min("id").alias("cluster"), F.max("id").alias("last"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select(*keys, "cluster")
    )
    return keyed.join(shared, keys).select(*keys, "cluster", "id")


def column_or_null(df: DataFrame, name: str, kind: str = "string") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)
