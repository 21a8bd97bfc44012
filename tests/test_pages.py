import json

import pytest
from pyspark.sql import functions as F

from rollcall.functions.html import (
    cms_of,
    contact_link,
    has_quiz,
    profile_exists,
    profile_is_relevant,
    profile_trust,
    relevant_links,
    social_links,
    tag_words,
    whatsapp_link,
    words_by_tag,
)
from rollcall.functions.urls import next_page_url
from rollcall.settings import RELEVANT_WORDS, TAG_WORDS
from rollcall.sources.cards import COMPANY_PAGE, DIRECTORY_FIRMS, DIRECTORY_MAP, DIRECTORY_PAGES, cards_in, cards_of, company_page_links
from rollcall.sources.jsonld import declared_total, listed_businesses, local_listings
from rollcall.sources.search import detail_rows, page_body, recover_json, search_listings, search_results, with_details

BASE = "https://site.ru"


@pytest.mark.parametrize(
    "html, found",
    [
        ('<a href="https://t.me/stone_shop">', {"telegram": "https://t.me/stone_shop"}),
        ('<a href="https://t.me/share/url?x=1">', {}),
        ('<a href="https://t.me/one/"><a href="https://t.me/two">', {"telegram": "https://t.me/one"}),
        ('<a href="https://www.vk.com/shop">', {"vk": "https://www.vk.com/shop"}),
        ('<a href="https://wa.me/79031234567">', {"whatsapp": "https://wa.me/79031234567"}),
        ('<a href="https://api.whatsapp.com/send?phone=7903">', {"whatsapp": "https://api.whatsapp.com/send?phone=7903"}),
        ("", {}),
    ],
)
def test_social_links(value, html, found):
    assert value(social_links(F.lit(html))) == found


def test_literal_whatsapp_rule_needs_the_bare_host(value):
    assert value(whatsapp_link(F.lit('<a href="https://wa.me/7903">'), literal=True)) is None
    assert value(whatsapp_link(F.lit('<a href="https://wa.me">'), literal=True)) == "https://wa.me"


@pytest.mark.parametrize(
    "html, url",
    [
        ('<a href="/contacts">Контакты</a>', "https://site.ru/contacts"),
        ('<a class="x" href="/kontakty"><b>Где мы</b></a>', "https://site.ru/kontakty"),
        ('<a href="/write">Написать\n нам</a>', "https://site.ru/write"),
        ('<a href="tel:+7">контакт</a><a href="/about">About</a>', None),
        ("", None),
    ],
)
def test_contact_link(value, html, url):
    assert value(contact_link(F.lit(html), F.lit(BASE))) == url


def test_relevant_links(value):
    html = (
        '<a href="/about">1</a><a href="/ABOUT">2</a><a href="https://o.ru/about">3</a><a href="#about">4</a>'
        '<a href="proizvodstvo">5</a><a href="https://site.ru/katalog">6</a><a href="/uslugi">7</a><a href="/x">8</a>'
    )
    found = value(relevant_links(F.lit(html), F.lit(BASE)))
    assert found == ["https://site.ru/about", "https://site.ru/proizvodstvo", "https://site.ru/katalog"]
    assert len(value(relevant_links(F.lit(html), F.lit(BASE), most=None))) == 4


@pytest.mark.parametrize(
    "html, cms",
    [
        ("wp-content bitrix", "wordpress"),
        ("/bitrix/", "bitrix"),
        ("created on Tilda", "tilda"),
        ("flexbe", "flexbe"),
        ("lpmotor", "lpmotor"),
        ("Joomla", "joomla"),
        ("route=common/home", "opencart"),
        ("plain", "unknown"),
    ],
)
def test_cms(value, html, cms):
    assert value(cms_of(F.lit(html))) == cms


def test_quiz_and_tags(value):
    assert value(has_quiz(F.lit("x marquiz.ru y"))) is True
    assert value(has_quiz(F.lit(None).cast("string"))) is False
    assert value(tag_words(F.lit("Новый станок с чпу, cnc"), TAG_WORDS["equipment"])) == ["ЧПУ", "CNC", "станок с ЧПУ"]


def test_words_of_all_tags_in_one_pass(value):
    text = "Лазерный станок с чпу и TILDAWEB; ретушь фото на памятник"
    by_tag = {tag: [w for w in words if w.lower() in text.lower()] for tag, words in TAG_WORDS.items()}
    assert value(words_by_tag(F.lit(text), TAG_WORDS)) == by_tag
    assert by_tag["site_constructor"] == ["tilda", "tildaweb"] and by_tag["portrait"] == ["ретушь фото", "фото на памятник"]
    assert value(words_by_tag(F.lit(None).cast("string"), TAG_WORDS)) == {tag: [] for tag in TAG_WORDS}
    nested = {"a": ("ab", "abc", "bca", "c.a"), "b": ("cab",)}
    assert value(words_by_tag(F.lit("xABCABcxa"), nested)) == {"a": ["ab", "abc", "bca"], "b": ["cab"]}


def test_profile(value):
    full = (
        '<img class="tgme_page_photo_image"><div class="tgme_page_description">Памятники</div>'
        '<div class="tgme_page_extra">5 subscribers</div><a class="a tgme_page_bot_button">b</a><div class="tgme_page_title">T</div>'
    )
    trust = value(profile_trust(F.lit(full)))
    assert trust.asDict() == {"has_avatar": True, "has_description": True, "is_bot": True, "is_channel": True, "trust_score": 0}
    assert value(profile_trust(F.lit("")))["trust_score"] == 0
    assert value(profile_trust(F.lit(None).cast("string")))["trust_score"] == 0
    assert value(profile_trust(F.lit('<i class="tgme_page_description_x">')))["has_description"] is False
    assert value(profile_is_relevant(F.lit(full), RELEVANT_WORDS)) is True
    assert value(profile_is_relevant(F.lit("памятник"), RELEVANT_WORDS)) is False
    assert value(profile_exists(F.lit("Telegram: Contact"))) is True


def page(items, extra=""):
    blocks = json.dumps({"@type": "ItemList", "itemListElement": [{"item": i} for i in items]}, ensure_ascii=False)
    return f'<html>{extra}<script type="application/ld+json">{blocks}</script></html>'


SHOP = {
    "@type": "LocalBusiness",
    "name": "Камень",
    "telephone": ["+7 (903) 123-45-67"],
    "address": {"streetAddress": "ул. Ленина, 10", "addressLocality": "Астрахань"},
    "url": "https://stone.ru",
    "sameAs": ["https://stone.ru", "https://vk.com/stone"],
    "geo": {"latitude": "46.35", "longitude": 48.03},
}


def jsonld(spark, *pages):
    rows = [("c", "Астрахань", i + 1, f"https://d.ru/{i}", html) for i, html in enumerate(pages)]
    return spark.createDataFrame(rows, "category string, city string, page int, url string, html string")


def test_jsonld_listing(spark):
    row = listed_businesses(jsonld(spark, page([SHOP]))).first()
    assert (row["name"], row["phones"], row["website"]) == ("Камень", ["79031234567"], "https://stone.ru")
    assert row["address_raw"] == "ул. Ленина, 10, Астрахань"
    assert (row["geo"].lat, row["geo"].lon) == (46.35, 48.03)


def test_jsonld_skips_what_is_no_business(spark):
    other = dict(SHOP, **{"@type": "Place"})
    nameless = {k: v for k, v in SHOP.items() if k != "name"}
    bad = '<script type="application/ld+json">{bad json}</script><script type="application/ld+json">[1, 2]</script>'
    assert listed_businesses(jsonld(spark, page([other, nameless], bad), bad)).count() == 0
    bare = {"@type": "LocalBusiness", "name": "N"}
    row = listed_businesses(jsonld(spark, page([bare]))).first()
    assert row["phones"] == [] and row["website"] is None and row["geo"] is None and row["address_raw"] == ""


def test_a_listing_address_counts_once_and_foreign_rows_do_not_use_it_up(spark):
    foreign = dict(SHOP, address={"addressLocality": "Москва"}, name="Чужой")
    no_url = {k: v for k, v in SHOP.items() if k != "url"}
    rows = local_listings(jsonld(spark, page([foreign, SHOP, no_url]), page([SHOP, no_url]))).collect()
    assert sorted((r["page"], r["org_url"]) for r in rows if r["org_url"]) == [(1, "https://stone.ru")]
    assert len([r for r in rows if r["org_url"] is None]) == 2
    assert "Чужой" not in {r["name"] for r in rows}


def test_declared_total_and_next_page(value):
    html = '<div class="cat-benefits"><ul><li>Отзывы</li><li>В городе 37 компаний</li></ul></div>'
    assert value(declared_total(F.lit(html))) == 37
    assert value(declared_total(F.lit("<div>37 компаний</div>"))) is None
    more = '<a class="company-list-next-link" data-url="/c/page-4/">Ещё</a>'
    assert value(next_page_url(F.lit(more), F.lit("https://d.ru/c/"), F.lit(3))) == "/c/page-4/"
    assert value(next_page_url(F.lit(""), F.lit("https://d.ru/c/?page=3"), F.lit(3))) == "https://d.ru/c/?page=4"


def cards(spark, html, rules):
    df = spark.createDataFrame([("T", "https://dir.ru/list", html)], "city string, url string, html string")
    return cards_of(df, rules).orderBy("pos").collect()


def test_cards_of_every_directory(spark):
    html = (
        '<div class="main-card"><div class="inner"><a class="firm-name x" href="/firm/1">Камень и Ко</a></div><div class="address">ул. 1</div>'
        '<span class="phone">8 (903) 123-45-67</span><a href="/firm/1">go</a><a href="https://vk.com/a">v</a><a href="https://vk.com/b">v</a></div>'
        '<div class="card"><div class="name">No</div></div>'
    )
    (row,) = cards(spark, html, DIRECTORY_MAP)
    assert (row["name"], row.phones, row.source_url, row.website) == ("Камень и Ко", ["79031234567"], "https://dir.ru/firm/1", None)
    assert row.messengers == {"vk": "https://vk.com/b"} and row.emails == []
    html = (
        '<div class="company-card"><h3><a href="/c">Камень</a></h3><address>ул. 2</address><span class="phone">+79031234567</span>'
        '<a href="https://yell.ru/x">y</a><a href="https://stone.ru">s</a><a class="website-link" href="https://late.ru">l</a> a@b.ru</div>'
        '<div class="listing-item"><span class="company-name">Второй</span><a class="website-link" href="/own">w</a></div>'
    )
    one, two = cards(spark, html, DIRECTORY_PAGES)
    assert (one["name"], one.address_raw, one.website, one.emails) == ("Камень", "ул. 2", "https://stone.ru", ["a@b.ru"])
    assert (two["name"], two.website, two.phones) == ("Второй", "/own", [])
    html = '<div class="company"><h2><a href="/f">Камень</a></h2><span class="phone">89031234567</span><a href="tel:8">8 903 222 22 22</a></div>'
    (row,) = cards(spark, html, DIRECTORY_FIRMS)
    assert row.phones == ["79031234567", "79032222222"] and row.website is None
    html = '<h1>Я</h1><a href="tel:1">9031234567</a><address>ул. 3</address><a href="https://jsprav.ru">j</a><a href="http://s.ru">s</a><a href="https://t.me/x">t</a>'
    (row,) = cards(spark, html, COMPANY_PAGE)
    assert (row["name"], row.website, row.messengers, row.pos) == ("Я", "http://s.ru", {"telegram": "https://t.me/x"}, 0)


def test_a_card_ends_where_its_element_ends(spark):
    html = (
        '<div class="list"><div class="card"><div class="card-name">Первая</div><div class="firm-phone phone">8 903 123 45 67</div></div>'
        '<a class="row" href="/firm/2"><span class="title">Вторая</span></a><p>between <a href="https://vk.com/between">b</a></p>'
        '<div class="card"><div class="card-name">Третья</div></div></div><div class="foot"><a href="https://t.me/foot">t</a></div>'
    )
    one, two, three = cards(spark, html, DIRECTORY_MAP)
    assert (one["name"], one.phones, one.messengers) == ("Первая", ["79031234567"], {})
    assert (two["name"], two.source_url, two.messengers) == ("Вторая", "https://dir.ru/firm/2", {})
    assert (three["name"], three.messengers) == ("Третья", {})
    cut = '<div class="company-card"><h3><a href="/company/1">Камень</a></h3><div>open <a href="https://t.me/own">t</a>'
    (row,) = cards(spark, cut, DIRECTORY_PAGES)
    assert (row["name"], row.messengers) == ("Камень", {"telegram": "https://t.me/own"})
    assert cards(spark, "no tags", DIRECTORY_PAGES) == [] and cards(spark, None, DIRECTORY_PAGES) == []


def test_company_page_links(spark):
    html = '<a href="/works/">all</a><a href="/works/a">a</a><a href="/works/a">a</a><a href="https://d.ru/works/b/">b</a><a href="/x">x</a>'
    df = spark.createDataFrame([("T", "https://d.ru/works/", html)], "city string, url string, html string")
    assert {r.url for r in company_page_links(df, "works").collect()} == {"https://d.ru/works/a", "https://d.ru/works/b/"}


def test_noisy_json(value):
    assert value(recover_json(F.lit(' {"a": 1} '))) == '{"a": 1}'
    assert value(recover_json(F.lit('log {"a": {"b": 2}} end'))) == '{"a": {"b": 2}}'
    assert value(recover_json(F.lit(""))) is None
    assert value(recover_json(F.lit("no json here"))) is None


def test_page_bodies(value):
    long = "x" * 60
    assert value(page_body(F.lit('{"data": {"markdown": "m", "html": "h"}}'))) == "m"
    assert value(page_body(F.lit('{"data": {"markdown": "", "html": "h"}}'))) == "h"
    assert value(page_body(F.lit('{"data": "plain"}'))) == "plain"
    assert value(page_body(F.lit('{"data": {}}'))) is None
    assert value(page_body(F.lit(long))) == long
    assert value(page_body(F.lit("short"))) is None


def test_search_to_listings_with_details(spark):
    web = [
        {"url": "https://a.ru/x", "title": "A"},
        {"url": "https://www.a.ru/y", "title": "A2"},
        {"url": "", "title": "none"},
        {"url": "https://b.ru"},
        {"url": "https://c.ru", "title": "C", "description": "d"},
    ]
    answers = spark.createDataFrame([("T", json.dumps({"data": {"web": web}}))], "city string, body string")
    assert search_results(answers, 3).count() == 3
    found = search_listings(answers)
    pages = spark.createDataFrame(
        [("https://a.ru/x", "Звоните +7 (903) 123-45-67, почта x@a.ru, г. Тверь, ул. Мира и ещё немного текста")], "url string, output string"
    )
    rows = {r["name"]: r for r in with_details(found, detail_rows(pages)).collect()}
    assert set(rows) == {"A", "A2", "C"}
    assert rows["A"].phones == ["79031234567"] and rows["A"].emails == ["x@a.ru"] and rows["A"].address_raw == "г. Тверь, ул. Мира"
    assert rows["A2"].phones == [] and rows["A2"].emails == [] and rows["C"].address_raw == ""


def test_cards_of_a_page_of_many_tags(spark):
    """Cards are cut by positions: a hundred thousand tags in one card, and as many in cards of their own."""
    inner = "".join(f"<div><a href='/x{i}'>t{i}</a></div>" for i in range(25_000))
    one = f'<div class="company-card">{inner}</div><div class="foot"><a href="/z">z</a></div>'
    many = "".join(f'<div class="company-card"><div>c{i}</div></div><p>' for i in range(5_000)) + '<a href="/company/9"><div class="company-card">in</div></a>'
    df = spark.createDataFrame([(1, one), (2, many), (3, None), (4, "")], "id int, html string")
    got = {r.id: r.cards for r in df.select("id", cards_in(F.col("html"), DIRECTORY_PAGES).alias("cards")).collect()}
    assert got[1] == [inner] and got[3] is None and got[4] == []
    assert got[2] == [f"<div>c{i}</div>" for i in range(5_000)] + ['<a href="/company/9"><div class="company-card">in</div>']
