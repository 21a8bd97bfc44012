"""Links, marks and class tests on stored HTML."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall.functions.binding import let
from rollcall.functions.texts import contains_any, strip
from rollcall.functions.urls import authority, resolve_link
from rollcall.schema import MESSENGERS, no_messengers, no_strings
from rollcall.settings import CMS_MARKS, CONTACT_HREF_WORDS, CONTACT_TEXT_WORDS, EXTRA_PAGE_WORDS, QUIZ_MARK

# How links of each kind are written in a page.
ANCHOR = r"""(?is)<a\s[^>]*href=["']([^"']+)["'][^>]*>(.*?)</a>"""
ANCHOR_OPEN = r"""(?i)<a\s[^>]*href=["']([^"']+)["']"""
UNFOLLOWED = r"^(#|javascript:|tel:|mailto:)"

TELEGRAM = r"""href=["'](https?://(?:t\.me|telegram\.me)/[^"'\s]+)["']"""
TELEGRAM_SKIP = r"share|joinchat"
WHATSAPP = r"""href=["'](https?://(?:wa\.me/[^"'\s]+|api\.whatsapp\.com/send\?phone=[^"'\s]+))["']"""
WHATSAPP_LITERAL = r"""href=["'](https?://(?:wa\.me|api\.whatsapp\.com/send\?phone=[^"'\s]+))["']"""
VK = r"""href=["'](https?://(?:www\.)?vk\.com/[^"'\s]+)["']"""



def every(text: Column, pattern: str, group: int = 1) -> Column:
    """All matches of a group, an empty list for a null text."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), no_strings())


def first(values: Column) -> Column:
    return F.get(values, 0)


def without_tags(html: Column) -> Column:
    return F.regexp_replace(html, r"<[^>]+>", "")


def anchors(html: Column) -> Column:
    """Links of a page in order, as (href, text), the text lower-cased and without tags."""
    pairs = F.arrays_zip(every(html, ANCHOR, 1).alias("href"), every(html, ANCHOR, 2).alias("text"))
    return F.transform(
        pairs, lambda p: F.struct(p["href"].alias("href"), F.lower(strip(without_tags(p["text"]))).alias("text"))
    )


def telegram_link(html: Column) -> Column:
    links = F.transform(every(html, TELEGRAM), lambda x: F.rtrim(x, F.lit("/")))
    return first(F.filter(links, lambda x: ~F.lower(x).rlike(TELEGRAM_SKIP)))


def whatsapp_link(html: Column, literal: bool = False) -> Column:
    return first(every(html, WHATSAPP_LITERAL if literal else WHATSAPP))


def vk_link(html: Column) -> Column:
    return first(every(html, VK))


def messenger_map(**links: Column) -> Column:
    """Map of the links that are present and not empty."""
    entries = F.array(*[F.struct(F.lit(kind).alias("key"), link.alias("value")) for kind, link in links.items()])
    present = F.filter(entries, lambda e: F.coalesce(e["value"], F.lit("")) != "")
    return F.map_from_entries(present).cast(MESSENGERS)


def social_links(html: Column, literal: bool = False) -> Column:
    """First Telegram, WhatsApp and VK link of a page."""
    return messenger_map(telegram=telegram_link(html), whatsapp=whatsapp_link(html, literal), vk=vk_link(html))


def add_missing_keys(known: Column, found: Column) -> Column:
    """``known`` plus the entries of ``found`` under keys that ``known`` lacks."""
    right = F.coalesce(found, no_messengers())
    return let(
        F.coalesce(known, no_messengers()),
        lambda left: F.map_concat(left, F.map_filter(right, lambda k, v: ~F.map_contains_key(left, k))),
    )


def contact_href(html: Column) -> Column:
    """First link to a contact page, by its text or its target, as it stands."""
    fits = F.filter(
        anchors(html),
        lambda a: ~a["href"].rlike(UNFOLLOWED)
        & (contains_any(a["text"], CONTACT_TEXT_WORDS) | contains_any(F.lower(a["href"]), CONTACT_HREF_WORDS)),
    )
    return first(F.transform(fits, lambda a: a["href"]))


def contact_link(html: Column, base: Column) -> Column:
    """The same as an absolute URL."""
    return resolve_link(F.concat(base, F.lit("/")), contact_href(html))


def relevant_hrefs(html: Column, words: tuple[str, ...] = EXTRA_PAGE_WORDS) -> Column:
    """Links whose target holds one of the words, as they stand."""
    return F.filter(every(html, ANCHOR_OPEN), lambda h: ~h.rlike(UNFOLLOWED) & contains_any(F.lower(h), words))


def relevant_links(html: Column, base: Column, words: tuple[str, ...] = EXTRA_PAGE_WORDS, most: int | None = 3) -> Column:
    """Links on the same host whose target holds one of the words, each once, the first ``most`` of them."""
    return links_on_site(relevant_hrefs(html, words), base, most)


def links_on_site(hrefs: Column, base: Column, most: int | None = 3) -> Column:
    """Absolute form of the links on the same host, each once, the first ``most`` of them.

    Targets that differ only in case count once; the first spelling is kept.
    """
    targets = F.transform(
        hrefs, lambda h: F.struct(F.lower(h).alias("low"), resolve_link(F.concat(base, F.lit("/")), h).alias("url"))
    )
    same_site = F.filter(targets, lambda t: authority(t["url"]) == authority(base))

    def firsts(links: Column) -> Column:
        once = F.filter(links, lambda t, i: F.array_position(links["low"], t["low"]) == i + 1)
        kept = F.slice(once, 1, most) if most is not None else once
        return kept["url"]

    return let(same_site, firsts)


def page_links(html: Column) -> Column:
    return every(html, ANCHOR_OPEN)


def cms_of(html: Column, marks=CMS_MARKS) -> Column:
    """Site builder by the first rule with a mark on the page, else ``unknown``."""
    name = F.lit(None).cast("string")
    for builder, words in reversed(marks):
        name = F.when(contains_any(html, words), F.lit(builder)).otherwise(name)
    return F.coalesce(name, F.lit("unknown"))


def has_quiz(html: Column, mark: str = QUIZ_MARK) -> Column:
    return F.coalesce(F.contains(html, F.lit(mark)), F.lit(False))


def class_attribute(name: str) -> str:
    """Pattern of a class attribute that holds the class ``name``."""
    return rf"""class=["'](?:[^"']*\s)?{name}(?:\s[^"']*)?["']"""


def has_class(html: Column, name: str) -> Column:
    return F.coalesce(html.rlike("(?i)" + class_attribute(name)), F.lit(False))


def profile_trust(html: Column) -> Column:
    """Trust of a stored messenger profile: +1 avatar, +1 description, -1 channel, -1 bot."""
    extra = F.regexp_extract(html, rf"(?is){class_attribute('tgme_page_extra')}[^>]*>(.*?)</div>", 1)
    extra_text = F.lower(without_tags(extra))
    avatar = has_class(html, "tgme_page_photo_image")
    description = has_class(html, "tgme_page_description")
    channel = F.coalesce(contains_any(extra_text, ("subscribers", "members")), F.lit(False))
    bot = has_class(html, "tgme_page_bot_button")
    score = avatar.cast("int") + description.cast("int") - channel.cast("int") - bot.cast("int")
    return F.struct(
        avatar.alias("has_avatar"),
        description.alias("has_description"),
        bot.alias("is_bot"),
        channel.alias("is_channel"),
        score.alias("trust_score"),
    )


def profile_exists(html: Column) -> Column:
    return F.coalesce(contains_any(html, ("tgme_action_button_new", "Telegram: Contact")), F.lit(False))


def profile_is_relevant(html: Column, words: tuple[str, ...]) -> Column:
    """A profile page whose title or description holds one of the words."""
    title = F.lower(F.regexp_extract(html, r"tgme_page_title[^>]*>([^<]+)", 1))
    description = F.lower(F.regexp_extract(html, r"tgme_page_description[^>]*>([^<]+)", 1))
    return F.coalesce(
        F.contains(html, F.lit("tgme_page_title")) & (contains_any(title, words) | contains_any(description, words)),
        F.lit(False),
    )


def tag_words(text: Column, words: tuple[str, ...]) -> Column:
    """The words found in a text, in list order, without regard to case."""
    lowered = F.lower(text)
    hits = [F.when(F.contains(lowered, F.lit(word.lower())), F.lit(word)) for word in words]
    return F.array_compact(F.array(*hits))


def words_by_tag(text: Column, tags: dict[str, tuple[str, ...]]) -> Column:
    """A map from each tag to its words that a text holds anywhere, in list order, without regard to case.

    All words of all tags are looked for in one pass: at every place the longest word that stands there is taken, and
    a found word stands for those that it begins with.
    """
    words = sorted({word.lower() for listed in tags.values() for word in listed}, key=lambda w: (-len(w), w))
    begins = "".join(sorted({re.escape(word[0]) for word in words}))
    pattern = f"(?=[{begins}])(?=({'|'.join(map(re.escape, words))}))"

    def all_tags(found: Column) -> Column:
        def held(word: str) -> Column:
            longer = [w for w in words if w.startswith(word.lower())]
            return F.arrays_overlap(found, F.array(*map(F.lit, longer)))

        lists = [F.array_compact(F.array(*[F.when(held(word), F.lit(word)) for word in listed])) for listed in tags.values()]
        return F.map_from_arrays(F.array(*map(F.lit, tags)), F.array(*lists))

    return let(F.array_distinct(every(F.lower(text), pattern)), all_tags)
