"""Listing cards and company pages of directories, by a rule table per directory.

A card runs from its opening tag to the closing tag that belongs to it. Tags inside a card that would open a card
elsewhere belong to the outer one, and what follows the last card of a page belongs to none.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.binding import let, rows_with
from rollcall.functions.emails import emails_in_text
from rollcall.functions.html import every, first, messenger_map, without_tags
from rollcall.functions.phones import normalize_phones
from rollcall.functions.texts import strip
from rollcall.functions.urls import resolve_link
from rollcall.schema import no_strings


def _tag(names: str, classes: str = "") -> str:
    """Pattern of the content of a tag, optionally one that carries one of the classes."""
    mark = rf"""\s[^>]*class=["'](?:[^"']*\s)?(?:{classes})(?:\s[^"']*)?["']""" if classes else r"\b"
    return rf"<(?:{names}){mark}[^>]*>(.*?)</(?:{names})>"


def _part(names: str, piece: str) -> str:
    """Pattern of the content of a tag whose class attribute holds the piece anywhere."""
    return rf"""<(?:{names})\s[^>]*class=["'][^"']*{piece}[^"']*["'][^>]*>(.*?)</(?:{names})>"""


HEADING_LINK = r"<h[23]\b[^>]*>\s*<a\b[^>]*>(.*?)</a>"


@dataclass(frozen=True)
class CardRules:
    source: str
    card: str | None
    names: tuple[str, ...]
    addresses: tuple[str, ...]
    phones: tuple[str, ...]
    all_phones: bool
    own_host: str
    link: str | None = None
    card_link: str | None = None
    website: bool = True
    site_class: str | None = None
    emails: bool = True
    messengers: tuple[str, ...] = ("telegram", "vk")
    shortest_name: int = 3


# Which marks of a directory's markup hold which field.
DIRECTORY_MAP = CardRules(
    source="2gis",
    card=r"""<div\s[^>]*class=["'][^"']*(?:card|firm)[^"']*["'][^>]*>""",
    names=(_part("div", "name"), _part("a", "name"), _part("span", "title")),
    addresses=(_part("div", "address"), _part("span", "address")),
    phones=(_part("div", "phone"), _part("span", "phone")),
    all_phones=False,
    own_host="2gis",
    link=r"""<a\s[^>]*href=["']([^"']*/firm/[^"']*)["']""",
    card_link="/firm/",
    website=False,
    emails=False,
    messengers=("telegram", "vk", "instagram"),
)
DIRECTORY_PAGES = CardRules(
    source="yell",
    card=r"""<div\s[^>]*class=["'](?:[^"']*\s)?(?:company-card|listing-item)(?:\s[^"']*)?["'][^>]*>""",
    names=(HEADING_LINK, _tag("a|span", "company-name")),
    addresses=(_tag("address"), _tag("div|span", "address")),
    phones=(_tag("span|a|div", "phone"),),
    all_phones=False,
    own_host="yell",
    card_link="/company/",
    site_class="website-link",
)
DIRECTORY_FIRMS = CardRules(
    source="firmsru",
    card=r"""<div\s[^>]*class=["'](?:[^"']*\s)?(?:company|firm-item)(?:\s[^"']*)?["'][^>]*>""",
    names=(HEADING_LINK, _tag("a|span", "name")),
    addresses=(_tag("address"), _tag("div|span", "address")),
    phones=(_tag("span|div", "phone"), r"""<a\s[^>]*href=["']tel:[^"']*["'][^>]*>(.*?)</a>"""),
    all_phones=True,
    own_host="firmsru",
    card_link="/firm/",
)
COMPANY_PAGE = CardRules(
    source="jsprav_playwright",
    card=None,
    names=(_tag("h1"),),
    addresses=(_tag("address"),),
    phones=(r"""<a\s[^>]*href=["']tel:[^"']*["'][^>]*>(.*?)</a>""",),
    all_phones=True,
    own_host="jsprav",
    shortest_name=1,
)

# Where a link of each kind leads.
LINK_MARKS = {"vk": r"vk[.]com", "telegram": r"t[.]me", "instagram": r"instagram[.]com"}


def _flags(pattern: str) -> str:
    return "(?is)" + pattern


def _content(html: Column, pattern: str) -> Column:
    return strip(without_tags(F.regexp_extract(html, _flags(pattern), 1)))


def _first_content(html: Column, patterns: tuple[str, ...]) -> Column:
    return F.coalesce(*[F.nullif(_content(html, p), F.lit("")) for p in patterns])


def _every_content(html: Column, patterns: tuple[str, ...]) -> Column:
    return F.concat(*[F.transform(every(html, _flags(p)), lambda t: strip(without_tags(t))) for p in patterns])


def _last_link(hrefs: Column, kind: str, kinds: tuple[str, ...]) -> Column:
    """Last link of a kind; a link counts for the first kind in the order vk, telegram, instagram it fits.

    Cards that know two kinds only look for telegram first.
    """
    order = [k for k in (("vk", "telegram", "instagram") if "instagram" in kinds else ("telegram", "vk")) if k in kinds]
    earlier = order[: order.index(kind)]

    def fits(href: Column) -> Column:
        ok = href.rlike(LINK_MARKS[kind])
        for other in earlier:
            ok = ok & ~href.rlike(LINK_MARKS[other])
        return ok

    return F.try_element_at(F.filter(hrefs, fits), F.lit(-1))


#: What a piece of a page opens with: a div that opens a card, another div, the end of one, a link to a card's page, the end of a link.
_CARD, _DIV, _END_DIV, _LINK, _END_LINK = 1, 2, 3, 4, 5


def cards_in(html: Column, rules: CardRules) -> Column:
    """The cards of a page in order: contents of the outermost elements that open a card, or a link to a card's page.

    The page is cut before every div and link tag. One pass over the marks of the pieces counts how deep each stands and notes
    the places of cards, and each card is then cut out once, so the work grows with the length of the page.
    """
    pieces = F.split(html, r"(?i)(?=</?(?:div|a)\b)")
    is_link = _flags(rf"""^<a\s[^>]*href=["'][^"']*{rules.card_link}""") if rules.card_link else None

    def mark(piece: Column) -> Column:
        found = F.when(piece.rlike(r"(?i)^</div\b"), _END_DIV).when(piece.rlike(r"(?i)^</a\b"), _END_LINK)
        if is_link:
            found = found.when(piece.rlike(is_link), _LINK)
        return found.when(piece.rlike(_flags("^" + rules.card)), _CARD).when(piece.rlike(r"(?i)^<div\b"), _DIV).otherwise(0)

    def step(state: Column, found: Column) -> Column:
        at, depth, opened = state["at"] + 1, state["depth"], state["opened"]
        inside = opened != 0
        opens = ~inside & found.isin(_CARD, _LINK)
        closes = (opened == _CARD) & (found == _END_DIV) & (depth == 1) | (opened == _LINK) & (found == _END_LINK)
        deeper = F.when(opens, 1).when(found.isin(_CARD, _DIV), depth + 1).when(found == _END_DIV, depth - 1).otherwise(depth)
        return F.struct(
            at.alias("at"),
            F.when(opens | inside, deeper).otherwise(0).alias("depth"),
            F.when(opens, found).when(closes, 0).otherwise(opened).alias("opened"),
            F.when(opens, at).otherwise(state["start"]).alias("start"),
            F.when(closes, F.concat(state["places"], F.array(F.struct(state["start"].alias("start"), at.alias("end"))))).otherwise(state["places"]).alias("places"),
        )

    def all_places(state: Column) -> Column:
        return F.when(state["opened"] != 0, F.concat(state["places"], F.array(F.struct(state["start"].alias("start"), (state["at"] + 1).alias("end"))))).otherwise(state["places"])

    nothing = F.array().cast("array<struct<start: int, end: int>>")
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("depth"), F.lit(0).alias("opened"), F.lit(0).alias("start"), nothing.alias("places"))

    def cut(parts: Column) -> Column:
        def card(place: Column) -> Column:
            opening = F.regexp_replace(F.element_at(parts, place["start"]), _flags("^<div[^>]*>"), "")
            return F.concat(opening, F.array_join(F.slice(parts, place["start"] + 1, place["end"] - place["start"] - 1), ""))

        return F.transform(F.aggregate(F.transform(parts, mark), start, step, all_places), card)

    return let(pieces, cut)


def cards_of(pages: DataFrame, rules: CardRules) -> DataFrame:
    """Listing rows from stored pages (city, url, html)."""
    if rules.card is None:
        cards = pages.select("city", "url", F.lit(0).alias("pos"), F.col("html").alias("card"))
    else:
        cards = pages.select("city", "url", F.posexplode(cards_in(F.col("html"), rules)).alias("pos", "card"))
    card = F.col("card")
    hrefs = every(card, r"""(?is)<a\s[^>]*href=["']([^"']+)["']""")
    numbers = _every_content(card, rules.phones) if rules.all_phones else F.array(_first_content(card, rules.phones))
    off_site = first(F.filter(hrefs, lambda h: F.contains(h, F.lit("http")) & ~F.contains(h, F.lit(rules.own_host))))
    website = off_site if rules.website else F.lit(None).cast("string")
    if rules.site_class:
        tag = F.regexp_extract(
            card, _flags(rf"""<a\s[^>]*class=["'](?:[^"']*\s)?{rules.site_class}(?:\s[^"']*)?["'][^>]*>"""), 0
        )
        marked = F.nullif(F.regexp_extract(tag, r"""(?is)href=["']([^"']+)["']""", 1), F.lit(""))
        marked_at = F.when(marked.isNotNull(), F.array_position(hrefs, marked))
        off_site_at = F.when(off_site.isNotNull(), F.array_position(hrefs, off_site))
        website = F.when(F.coalesce(marked_at <= off_site_at, marked_at.isNotNull()), marked).otherwise(off_site)
    source_url = F.col("url")
    if rules.link:
        found = F.nullif(F.regexp_extract(card, _flags(rules.link), 1), F.lit(""))
        source_url = F.coalesce(resolve_link(F.col("url"), found), F.lit(""))
    named = let(_first_content(card, rules.names), lambda name: F.when(F.length(name) >= rules.shortest_name, name))
    return cards.select(
        "city",
        F.lit(rules.source).alias("source"),
        "url",
        "pos",
        source_url.alias("source_url"),
        rows_with(named).alias("name"),
        normalize_phones(numbers).alias("phones"),
        F.coalesce(_first_content(card, rules.addresses), F.lit("")).alias("address_raw"),
        website.alias("website"),
        (emails_in_text(card) if rules.emails else no_strings()).alias("emails"),
        messenger_map(**{kind: _last_link(hrefs, kind, rules.messengers) for kind in rules.messengers}).alias("messengers"),
    )


def company_page_links(pages: DataFrame, category: str) -> DataFrame:
    """(city, url): distinct company pages linked from a category page, without the category page itself."""
    links = pages.select("city", F.col("url").alias("base"), F.explode(every(F.col("html"), r"""(?is)<a\s[^>]*href=["']([^"']+)["']""")).alias("href"))
    inside = links.where(
        F.contains("href", F.lit(f"/{category}/")) & ~F.endswith(F.rtrim("href", F.lit("/")), F.lit(category))
    )
    return inside.select("city", resolve_link(F.col("base"), F.col("href")).alias("url")).distinct()


def union_sources(*tables: DataFrame) -> DataFrame:
    """Listings of several sources in one table; a column a source lacks is null."""
    united = tables[0]
    for other in tables[1:]:
        united = united.unionByName(other, allowMissingColumns=True)
    return united
