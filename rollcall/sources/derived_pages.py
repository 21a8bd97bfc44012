"""Stored pages of shops, profiles and directories, written out from the listings.

The driver's own pages hold no contact links, JSON-LD or listing cards; these do, and
they grow with the customer table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.sources.driver_tables import dealt

CMS_SNIPPETS = (
    "<p>plain</p>",
    '<link href="/wp-content/a.css">',
    '<script src="/bitrix/js.js"></script>',
    "<p>created on Tilda</p>",
    '<img src="https://flexbe.com/i.png">',
    "<!-- lpmotor -->",
    '<meta name="generator" content="Joomla!">',
    '<a href="/index.php?route=common/home">H</a>',
)


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _if(condition: Column, *parts: Column | str) -> Column:
    return F.when(condition, _text(*parts)).otherwise(F.lit(""))


def shop_site(key: Column) -> Column:
    """Two neighbouring listings share a shop site."""
    return _text("https://shop", F.floor(key / 2).cast("string"), ".example.ru")


def shop_pages(listings: DataFrame) -> DataFrame:
    """(url, status, html): home, contact and further pages of every shop."""
    shops = dealt(listings.select(F.floor(F.col("id") / 2).alias("s")), "s").distinct().withColumn("t", F.col("s").cast("string"))
    s, t = F.col("s"), F.col("t")
    root = _text("https://shop", t, ".example.ru")
    snippets = F.array(*[F.lit(x) for x in CMS_SNIPPETS])
    home = _text(
        "<html><body>",
        _if(s % 4 == 1, '<a href="https://t.me/share/url?u=1">S</a>'),
        _if(s % 3 == 0, '<a class="m" href="https://t.me/shop', t, '/">T</a>'),
        _if(s % 5 == 0, '<a href="https://www.vk.com/shop', t, '">V</a>'),
        '<a href="/about">About</a><a href="tel:+7">контакт</a>',
        _if(s % 7 != 0, '<a class="c" href="/kontakty/"><b>Наши КОНТАКТЫ</b></a>'),
        F.element_at(snippets, (s % 8 + 1).cast("int")),
        _if(s % 9 == 0, '<script src="https://marquiz.ru/q.js"></script>'),
        "</body></html>",
    )
    contact = _text(
        "<html><body>",
        _if(s % 6 == 1, '<a href="https://wa.me/7900', t, '">W</a>'),
        _if(s % 6 == 2, '<a href="https://telegram.me/late', t, '">T</a>'),
        '<a href="/about">A</a><a href="katalog?x=1">K</a><a href="https://other.example.ru/about">O</a>',
        '<a href="/ABOUT">D</a><a href="/uslugi">U</a><a href="/services">X</a></body></html>',
    )
    about = _text("<html>", _if(s % 10 == 3, '<a href="https://t.me/about', t, '">T</a>'), "</html>")
    catalogue = _text(
        "<html>", _if(s % 10 == 5, '<a href="https://api.whatsapp.com/send?phone=7', t, '">W</a>'), "</html>"
    )
    offers = _text("<html>", _if(s % 2 == 1, '<a href="http://vk.com/offer', t, '">V</a>'), "</html>")
    services = F.lit('<a href="https://vk.com/never">V</a>')
    each = F.array(
        *[
            F.struct(_text(root, path).alias("url"), status.alias("status"), html.alias("html"))
            for path, status, html in (
                ("/", F.when(s % 13 == 0, 404).otherwise(200), home),
                ("/kontakty/", F.lit(200), contact),
                ("/about", F.lit(200), about),
                ("/katalog?x=1", F.lit(200), catalogue),
                ("/uslugi", F.lit(200), offers),
                ("/services", F.lit(200), services),
            )
        ]
    )
    return shops.select(F.explode(each).alias("page")).select("page.*")


def profiles(listings: DataFrame) -> DataFrame:
    """(url, html): stored messenger profiles; every third one is about the trade."""
    k, t = F.col("id"), F.col("id").cast("string")
    html = _text(
        '<div class="page tgme_page"><div class="tgme_page_title" dir="auto"><span></span></div>',
        '<div class="tgme_page_title">Shop ',
        t,
        "</div>",
        _if(k % 2 == 0, '<img class="tgme_page_photo_image" src="a.png">'),
        _if(k % 3 == 0, '<div class="tgme_page_description ">Памятники и ангел, ', t, "</div>"),
        _if(k % 5 == 0, '<div class="tgme_page_extra"><b>12</b> Subscribers</div>'),
        _if(k % 7 == 0, '<a class="x tgme_page_bot_button">Start</a>'),
        _if(k % 4 == 0, '<a class="tgme_action_button_new">Send</a>'),
        "</div>",
    )
    return listings.select(_text("https://t.me/shop", t).alias("url"), html.alias("html"))


def directory_pages(listings: DataFrame) -> DataFrame:
    """(category, city, page, url, html): one JSON-LD page per eight listings of a city.

    Every page lists its shops twice under one address, holds one broken block, and one
    shop in six stands in another place.
    """
    k, t = F.col("id"), F.col("id").cast("string")
    locality = (
        F.when(k % 6 == 0, "Elsewhere").when(k % 6 == 1, "").when(k % 6 == 2, F.lower("city")).otherwise(F.col("city"))
    )
    numbers = F.transform("phones", lambda p: F.concat(F.lit('"'), p, F.lit('"')))
    item = _text(
        '{"@type": "ListItem", "item": {"@type": "',
        F.when(k % 10 == 9, "Place").otherwise("LocalBusiness"),
        '", "name": "',
        F.col("name"),
        '", "telephone": [',
        F.array_join(numbers, ", "),
        '], "address": {"streetAddress": "Street ',
        t,
        '", "addressLocality": "',
        locality,
        '"}',
        _if(k % 4 != 0, ', "url": "https://org.example.ru/', F.floor(k / 3).cast("string"), '"'),
        _if(F.col("website").isNotNull(), ', "sameAs": ["', F.coalesce("website", F.lit("")), '", "https://vk.com/x"]'),
        ', "geo": {"latitude": "',
        F.when(k % 5 == 0, "0").when(k % 5 == 1, "north").otherwise(F.concat(F.lit("5"), (k % 10).cast("string"), F.lit(".5"))),
        '", "longitude": "3',
        (k % 7).cast("string"),
        '.25"}}}',
    )
    shelved = listings.select("city", F.floor(k / 200).alias("page"), F.struct(k, item.alias("item")).alias("entry"))
    pages = shelved.groupBy("city", "page").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("entry")), lambda e: e["item"]), ", ").alias("items"),
        F.count(F.lit(1)).alias("n"),
    )
    block = F.concat(F.lit('<script type="application/ld+json">{"@type": "ItemList", "itemListElement": ['), "items", F.lit("]}</script>"))
    html = _text(
        '<html><div class="box cat-benefits"><ul><li>Фото</li><li><b>',
        F.col("n").cast("string"),
        "</b> компаний</li></ul></div>",
        block,
        '<script type="application/ld+json">{bad json}</script>',
        '<script type="application/ld+json">{"@type": "WebSite", "itemListElement": []}</script>',
        block,
        _if(F.col("page") % 2 == 0, '<a class="btn company-list-next-link" data-url="https://dir.example.ru/next/', F.col("page").cast("string"), '">More</a>'),
        "</html>",
    )
    return pages.select(
        F.lit("monuments").alias("category"),
        "city",
        (F.col("page") + 1).alias("page"),
        _text("https://dir.example.ru/", F.lower("city"), "/?page=", (F.col("page") + 1).cast("string")).alias("url"),
        html.alias("html"),
    )


FOOTER = '<div class="foot"><a href="https://t.me/foot">t</a><a href="https://vk.com/foot">v</a><a href="https://instagram.com/foot">i</a>foot@example.ru</div>'


def card_pages(listings: DataFrame, directory: str) -> DataFrame:
    """(city, url, html): pages with two listing cards each, in the markup of a directory.

    Cards hold further elements that would open a card elsewhere, and pages end in a footer with links of its own.
    """
    k, t = F.col("id"), F.col("id").cast("string")
    phone = F.coalesce(F.get("phones", 0), F.lit("no phone"))
    second = F.coalesce(F.get("phones", 1), F.lit("none"))
    site = F.coalesce("website", F.lit("/inner"))
    name = F.when(k % 12 == 5, "ab").otherwise(F.col("name"))
    links = _text(
        '<a href="https://t.me/old">o</a>',
        _if(k % 3 == 1, '<a href="https://t.me/shop', t, '">t</a>'),
        _if(k % 5 == 3, '<a href="https://vk.com/shop', t, '">v</a>'),
    )
    if directory == "map":
        card = _text(
            '<div class="_card_1"><div class="card-head firm-head"><a href="/firm/', t, '"><span class="title"><b>', name, "</b></span></a></div>",
            '<span class="item_address">', F.col("address_raw"), '</span><span class="the-phone">', phone, "</span>", links,
            _if(k % 7 == 0, '<a href="https://instagram.com/shop', t, '">i</a>'), "</div>",
        )
    elif directory == "pages":
        card = _text(
            '<div class="big company-card"><div class="listing-item"><h3> <a href="/company/', t, '">', name, "</a></h3></div><address>", F.col("address_raw"),
            '</address><span class="phone">', phone, '</span><a href="https://yell.example.ru/x">in</a>',
            _if(k % 2 == 0, '<a class="website-link" href="', site, '">site</a>'), links,
            "<p>mail: box", t, "@example.ru</p></div>",
        )
    elif directory == "firms":
        card = _text(
            '<div class="firm-item"><div class="company"><span class="name">', name, '</span></div><div class="address">', F.col("address_raw"),
            '</div><span class="phone">', phone, '</span><a href="tel:1">', second, '</a><a href="http://firmsru.example/">in</a>',
            links, "<p>box", t, "@example.ru, box", t, "@example.ru</p></div>",
        )
    else:
        card = _text(
            "<h1> ", name, '</h1><a href="tel:1">', phone, '</a><a href="tel:2">', second, "</a><address>", F.col("address_raw"),
            '</address><a href="https://jsprav.example/">in</a><a href="', site, '">site</a>', links, "<p>box", t, "@example.ru</p>",
        )
    if directory == "company":
        return listings.select("city", _text("https://dir.example.ru/c/", t).alias("url"), card.alias("html"))
    shelf = F.floor(k / 2)
    return (
        listings.select("city", shelf.alias("shelf"), F.struct(k, card.alias("card")).alias("entry"))
        .groupBy("city", "shelf")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list("entry")), lambda e: e["card"]), "").alias("cards"))
        .select(
            "city",
            _text("https://dir.example.ru/p/", F.col("shelf").cast("string")).alias("url"),
            F.concat(F.lit("<html><body><div>"), "cards", F.lit(f"</div>{FOOTER}</body></html>")).alias("html"),
        )
    )


def search_answers(listings: DataFrame) -> DataFrame:
    """(id, name, city, body): three search hits per listing; some bodies come with noise around the JSON."""
    k, t = F.col("id"), F.col("id").cast("string")
    first_word = F.lower(F.substring_index("name", " ", 1))
    json = _text(
        '{"data": {"web": [{"url": "https://portal.example.ru/', F.floor(k / 5).cast("string"), '", "title": "Portal", "description": "d"}, {"url": "',
        F.when(k % 11 == 0, "").otherwise(_text("https://found", t, ".example.ru")),
        '", "title": "',
        F.when(k % 3 == 0, F.concat(F.lit("About "), first_word)).when(k % 3 == 1, "Other").otherwise(""),
        '"}, {"url": "https://third', t, '.example.ru", "title": "', first_word, ' LLC", "description": null}]}}',
    )
    body = F.when(k % 8 == 0, F.lit("")).when(k % 8 == 1, F.lit("not json {at all")).when(k % 8 == 2, _text("  ", json, "\n")).otherwise(json)
    return listings.select("id", "name", "city", body.alias("body"))


def noisy_outputs(listings: DataFrame) -> DataFrame:
    """(id, url, output): page fetches as JSON, JSON inside other text, plain text, and failures."""
    k, t = F.col("id"), F.col("id").cast("string")
    text = _text(
        "Call +7 (495) 123-45-", F.lpad((k % 100).cast("string"), 2, "0"), " or mail box", t,
        "@example.ru, г. Тверь, ул. Мира and г. Тверь, Лесная 5",
    )
    output = (
        F.when(k % 6 == 0, _text('{"data": {"markdown": "', text, '"}}'))
        .when(k % 6 == 1, _text('log line {"data": {"markdown": "", "html": "', text, '"}} done'))
        .when(k % 6 == 2, text)
        .when(k % 6 == 3, _text('{"data": "', text, '"}'))
        .when(k % 6 == 4, "short")
        .otherwise("")
    )
    return listings.select("id", _text("https://found", t, ".example.ru").alias("url"), output.alias("output"))
