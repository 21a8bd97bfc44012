"""Hosts, domains, relative links and website clean-up."""

from __future__ import annotations

import ipaddress

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall.functions.binding import let
from rollcall.functions.texts import strip
from rollcall.settings import LOCAL_HOSTS, PRIVATE_NETWORKS

AUTHORITY = r"^[^:/?#]+://([^/?#]*)"
SCHEME = r"^[a-zA-Z][a-zA-Z0-9+.\-]*:"


def authority(url: Column) -> Column:
    """Everything between ``://`` and the path, as written; empty without a scheme."""
    return F.regexp_extract(url, AUTHORITY, 1)


def domain_of(url: Column, literal: bool = False) -> Column:
    """Lower-cased host with port, or null. A missing scheme is allowed.

    Drops a leading ``www.``; ``literal`` drops every ``www.``.
    """
    full = F.when(F.contains(url, F.lit("://")), url).otherwise(F.concat(F.lit("https://"), url))
    host = F.lower(authority(full))
    bare = F.replace(host, F.lit("www."), F.lit("")) if literal else F.regexp_replace(host, r"^www\.", "")
    return F.nullif(bare, F.lit(""))


HOST = r"^[^:/?#]+://(?:[^/?#]*@)?(?:\[([^\]/?#]*)\]|([^/?#:\[\]]*))"
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


def host_name(url: Column) -> Column:
    """Lower-cased host without user, port and brackets; empty when there is none."""
    return F.lower(F.concat(F.regexp_extract(url, HOST, 1), F.regexp_extract(url, HOST, 2)))


def network_pattern(network: str) -> str:
    """Pattern of the dotted addresses of an IPv4 network."""
    net = ipaddress.ip_network(network)
    pairs = zip(net.network_address.packed, net.broadcast_address.packed)
    octets = [
        OCTET if (low, high) == (0, 255) else "(?:" + "|".join(str(n) for n in range(low, high + 1)) + ")"
        for low, high in pairs
    ]
    return r"\.".join(octets)


INTERNAL_HOST = (
    "^(?:|"
    + "|".join([host.replace(".", r"\.") for host in LOCAL_HOSTS])
    + "|"
    + "|".join(network_pattern(n) for n in PRIVATE_NETWORKS)
    + r"|(?:f[cd][0-9a-f]{2}|fe[89ab][0-9a-f]):[0-9a-f:.]*|(?:0{1,4}:){7}0{0,3}1)$"
)


def is_internal_url(url: Column) -> Column:
    """No host, a local host, or an address in a private network."""
    return F.coalesce(host_name(url).rlike(INTERNAL_HOST), F.lit(True))


def clean_website(value: Column) -> Column:
    """Usable address of a site, or null for placeholders and internal hosts."""

    def cleaned(text: Column) -> Column:
        full = F.when(F.startswith(text, F.lit("http")), text).otherwise(F.concat(F.lit("https://"), text))
        usable = (text != "") & ~text.isin("-", "N/A")
        return F.when(usable, let(full, lambda u: F.when(~is_internal_url(u), F.regexp_extract(u, r"^\S+", 0))))

    return let(strip(value), cleaned)


def site_root(url: Column) -> Column:
    """Address without closing slashes, the base of a site scan."""
    return F.rtrim(url, F.lit("/"))


def _without_dots(path: Column) -> Column:
    """Resolves ``.`` and ``..`` segments of an absolute path."""
    return let(F.split(path, "/"), _joined_segments)


def _joined_segments(parts: Column) -> Column:
    closing = F.when(F.element_at(parts, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    kept = F.aggregate(
        F.slice(parts, 2, F.size(parts)),
        F.array().cast("array<string>"),
        lambda done, part: F.when(part == ".", done)
        .when(part == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .otherwise(F.concat(done, F.array(part))),
    )
    return F.concat(F.lit("/"), F.array_join(F.concat(kept, closing), "/"))


def resolve_link(base: Column, href: Column) -> Column:
    """Absolute form of a link found on a page: absolute, ``//host``, ``/path``, ``?query``, ``#mark``, relative."""
    return let(base, lambda b: let(href, lambda h: _resolved(b, h)))


def _resolved(base: Column, href: Column) -> Column:
    root = F.regexp_extract(base, r"^[^:/?#]+://[^/?#]*", 0)
    scheme = F.regexp_extract(base, r"^[^:/?#]+:", 0)
    no_mark = F.substring_index(base, "#", 1)
    no_query = F.substring_index(no_mark, "?", 1)
    base_path = F.substring(no_query, F.length(root) + 1, F.length(no_query))
    folder = F.coalesce(F.nullif(F.regexp_extract(base_path, r"^.*/", 0), F.lit("")), F.lit("/"))
    raw = F.when(F.startswith(href, F.lit("/")), href).otherwise(F.concat(folder, href))

    def joined_path(full: Column) -> Column:
        path = F.regexp_extract(full, r"^[^?#]*", 0)
        tail = F.substring(full, F.length(path) + 1, F.length(full))
        return F.when(full.rlike(r"^[^?#]*/\.\.?([/?#]|$)"), F.concat(_without_dots(path), tail)).otherwise(full)

    joined = F.concat(root, let(raw, joined_path))
    return (
        F.when(href == "", base)
        .when(href.rlike(SCHEME), href)
        .when(F.startswith(href, F.lit("//")), F.concat(scheme, href))
        .when(F.startswith(href, F.lit("?")), F.concat(no_query, href))
        .when(F.startswith(href, F.lit("#")), F.concat(no_mark, href))
        .otherwise(joined)
    )


def page_number(url: Column) -> Column:
    """``page-3``, ``page3`` or ``page=3`` as 3, else 1."""
    number = F.coalesce(
        F.regexp_extract(url, r"page-?(\d+)", 1).try_cast("int"),
        F.regexp_extract(url, r"page=(\d+)", 1).try_cast("int"),
    )
    return F.coalesce(number, F.lit(1))


def next_page_url(html: Column, url: Column, page: Column) -> Column:
    """Target of the page's "more" link, else the same address with the next page number."""
    tag = F.regexp_extract(html, r"""(?is)<a\s[^>]*class=["'](?:[^"']*\s)?company-list-next-link(?:\s[^"']*)?["'][^>]*>""", 0)
    target = F.nullif(F.regexp_extract(tag, r"""(?is)\sdata-url=["']([^"']+)["']""", 1), F.lit(""))
    plain = F.regexp_extract(url, r"^[^?#]*", 0)
    return F.coalesce(target, F.concat(plain, F.lit("?page="), (page + 1).cast("string")))
