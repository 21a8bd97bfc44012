import pytest
from pyspark.sql import functions as F

from rollcall.operators.gaps import best_hits, fill_gaps, fill_statistics, missing_contacts, one_per_page, only_new
from rollcall.operators.merge import fact_counts, nest, unnest
from rollcall.operators.network import flag_networks
from rollcall.operators.places import (
    active_sources,
    best_localities,
    known_categories,
    listing_urls,
    region_cities,
    resolve_subdomains,
    standard_active_sources,
)
from rollcall.operators.presets import apply_preset
from rollcall.operators.scoring import score_companies, segment_histogram, top_scored
from rollcall.operators.site_scan import found_handles, handle_candidates, scan_sites, verified_handles
from rollcall.operators.stages import collection_gaps, stage_by_city
from rollcall.schema import ENRICHED, with_known_source, with_null_defaults

TEST_WEIGHTS = {
    "has_website": 10,
    "cms_bitrix": 15,
    "cms_modern": 10,
    "has_marquiz": 10,
    "has_telegram": 15,
    "tg_trust_multiplier": 5,
    "has_whatsapp": 10,
    "multiple_phones": 5,
    "has_email": 5,
    "is_network": 5,
}


def company(id=1, name="Камень", phones=(), website=None, emails=(), city="T", messengers=None, trust=None, cms="unknown", quiz=False, network=False, score=None, segment=None):
    tg = None if trust is None else (None, None, None, None, trust)
    return (id, name, list(phones), "", website, list(emails), city, messengers or {}, tg, cms, quiz, network, score, segment)


def table(spark, *rows):
    return spark.createDataFrame(list(rows), ENRICHED)


def scores(spark, *rows, weights=TEST_WEIGHTS):
    scored = score_companies(table(spark, *rows), weights)
    return [r.crm_score for r in scored.orderBy("id").collect()]


def test_scores(spark):
    tg = {"telegram": "t"}
    assert scores(
        spark,
        company(1, website="s"),
        company(2, website="s", cms="wordpress"),
        company(3, website="s", cms="bitrix"),
        company(4, website="s", messengers=tg, trust=2),
        company(5, messengers=tg, trust=-2),
        company(6, cms="bitrix", quiz=True),
        company(7, website="s", cms="bitrix", quiz=True, messengers={"telegram": "t", "whatsapp": "w"}, trust=3, phones="ab", emails="c", network=True),
        company(8, website="", messengers={"telegram": ""}, trust=9),
    ) == [10, 20, 25, 35, 5, 0, 90, 0]


def test_segments_and_histogram(spark):
    levels = {"segment_A": 60, "segment_B": 40, "segment_C": 20}
    weights = {"has_website": 60, "has_email": 0}
    rows = [company(i, website="s") for i in range(3)] + [company(9)]
    scored = score_companies(table(spark, *rows), weights, levels)
    assert {r.segment: r.companies for r in segment_histogram(scored).collect()} == {"A": 3, "D": 1}
    assert [r.id for r in top_scored(scored, 2).collect()] == [0, 1]
    from rollcall.functions.scores import segment_of

    points = spark.createDataFrame([(60,), (59,), (40,), (39,), (20,), (19,)], "s int")
    assert [r[0] for r in points.select(segment_of(F.col("s"), {})).collect()] == list("ABBCCD")
    assert [r[0] for r in points.select(segment_of(F.col("s"))).collect()] == list("AABBCC")


def test_networks(spark):
    rows = [
        company(1, website="https://a.ru/x", city="T"),
        company(2, website="www.a.ru", city="T"),
        company(3, website="a.ru", city="U"),
        company(4, phones=["89031234567", "+79031234567"], city="T"),
        company(5, phones=["79032222222"], city="T"),
        company(6, phones=["8 903 222-22-22"], city="T", network=True),
        company(7, city="T", network=True),
    ]
    flags = lambda **kw: {r.id for r in flag_networks(table(spark, *rows), **kw).where("is_network").collect()}
    assert flags() == {1, 2, 5, 6}
    assert flags(occurrences=True) == {1, 2, 4, 5, 6}
    assert flags(scope=()) == {1, 2, 3, 5, 6}
    assert flags(threshold=3) == set()


def chosen(spark, filters, literal=False):
    rows = [
        company(1, messengers={"telegram": "t"}, emails=["a"], score=60, segment="A"),
        company(2, messengers={"whatsapp": "w"}, emails=["a"], score=20, segment="C"),
        company(3, emails=["a"], score=5, segment="D"),
        company(4, score=0, segment="D"),
    ]
    return {r.id for r in apply_preset(table(spark, *rows), filters, literal).collect()}


def test_presets(spark):
    assert chosen(spark, "1=1") == chosen(spark, "") == chosen(spark, None) == {1, 2, 3, 4}
    assert chosen(spark, "telegram IS NOT NULL AND crm_score >= 50") == {1}
    assert chosen(spark, "segment = 'D'") == {3, 4}
    assert chosen(spark, "telegram IS NULL AND whatsapp IS NULL and emails IS NOT NULL") == {3}
    assert chosen(spark, "email IS NOT NULL AND priority_score >= 20") == {1, 2}
    assert chosen(spark, "has_production = 1 AND status != 'contacted' AND telegram IS NOT NULL") == {1}
    assert chosen(spark, "crm_score >= 50", literal=True) == {1, 2, 3, 4}
    assert chosen(spark, "priority_score >= 50 AND segment = 'D'", literal=True) == {1}


def test_null_defaults_and_sources(spark):
    bare = spark.createDataFrame([(1,) + (None,) * 13], ENRICHED)
    row = with_null_defaults(bare).first()
    assert row.phones == [] and row.emails == [] and row.messengers == {} and row.website is None
    named = spark.createDataFrame([("2gis",), ("elsewhere",)], "source string")
    assert [r.source_known for r in with_known_source(named).collect()] == [True, False]


def test_new_and_missing(spark):
    rows = table(spark, company(1, website="s", emails=["a"]), company(2, website="s"), company(3, website="", emails=["a"]), company(4))
    assert {r.id for r in missing_contacts(rows).collect()} == {2, 3, 4}
    assert {r.id for r in only_new(rows, rows.where("id > 2")).collect()} == {1, 2}


def test_best_hits(spark):
    companies = table(spark, company(1, "Мир Камня Тверь"), company(2, "ИП ЛП"), company(3, "Камень"), company(4, "Камень"))
    hits = spark.createDataFrame(
        [
            (1, 0, "https://p.ru", "Каталог"),
            (1, 1, "", "Мир камня"),
            (1, 2, "https://m.ru", "О компании МИР КАМНЯ"),
            (2, 0, "https://q.ru", "ИП ЛП"),
            (2, 1, "https://r.ru", "ИП"),
            (3, 0, "", "Прочее"),
            (3, 1, "https://s.ru", "Прочее"),
        ],
        "id long, pos int, url string, title string",
    )
    assert {r.id: r.url for r in best_hits(companies, hits).collect()} == {1: "https://m.ru", 2: "https://q.ru"}
    assert {r.id: r.url for r in best_hits(companies, hits, rank_titles=False).collect()} == {1: "https://p.ru", 2: "https://q.ru"}


def test_filling_gaps(spark):
    rows = table(
        spark,
        company(1, phones=["79030000001"], messengers={"vk": "old"}),
        company(2, website="https://own.ru", cms="bitrix"),
        company(3, website="https://own.ru", emails=["x@y.ru"]),
        company(4),
    )
    facts = unnest(rows)
    companies = rows.drop("phones", "emails").join(fact_counts(facts), "id", "left").na.fill(0, ["n_phones", "n_emails"])
    details = spark.createDataFrame(
        [
            (1, "https://f1.ru", ["a@f.ru", "a@f.ru"], ["+7 903 000-00-01", "89030000002", "bad"], {"vk": "new", "telegram": "t"}, "tilda"),
            (2, "https://f2.ru", ["b@f.ru"], [], {}, "tilda"),
            (3, "https://f3.ru", ["c@f.ru"], ["89030000003"], {"telegram": "t"}, "tilda"),
        ],
        "id long, url string, emails array<string>, phones array<string>, messengers map<string,string>, cms string",
    )
    filled = fill_gaps(companies, facts, details)
    got = {r.id: r for r in nest(filled.companies, filled.facts).collect()}
    assert (got[1].website, got[1].phones, got[1].emails, got[1].cms) == ("https://f1.ru", ["79030000001", "79030000002"], ["a@f.ru"], "tilda")
    assert got[1].messengers == {"vk": "old", "telegram": "t"} and (got[1].n_phones, got[1].n_emails) == (2, 1)
    assert (got[2].website, got[2].emails, got[2].cms) == ("https://own.ru", ["b@f.ru"], "bitrix")
    assert (got[3].emails, got[3].phones, got[3].messengers) == (["x@y.ru"], [], {})
    assert got[4].website is None
    added = sorted((r.id, r.field) for r in filled.added.collect())
    assert added == [(1, "cms:tilda"), (1, "email"), (1, "phone"), (1, "telegram"), (1, "website"), (2, "email")]
    totals = {r.field: (r.values_added, r.companies) for r in fill_statistics(filled, missing_contacts(companies)).collect()}
    assert totals["improved"] == (6, 2) and totals["attempted"] == (0, 3) and totals["email"] == (2, 2) and totals["cms"] == (1, 1)
    literal = fill_gaps(companies, facts, details, literal=True).facts.where("kind = 'phone' and id = 1")
    assert {r.value for r in literal.collect()} == {"79030000001", "+79030000001", "89030000002", "bad"}


def test_site_scan(spark):
    pages = spark.createDataFrame(
        [
            ("https://a.ru/", 200, '<a href="https://vk.com/a">v</a><a href="/contacts">c</a> wp-content'),
            ("https://a.ru/contacts", 200, '<a href="/about">x</a><a href="/uslugi">y</a>'),
            ("https://a.ru/about", 200, '<a href="https://t.me/a">t</a><a href="https://wa.me/7">w</a>'),
            ("https://a.ru/uslugi", 200, '<a href="https://t.me/late">t</a>'),
            ("https://b.ru", 200, '<a href="https://t.me/b">t</a><a href="/contacts">c</a>marquiz.ru'),
            ("https://b.ru/contacts", 200, '<a href="https://wa.me/8">w</a>'),
            ("https://c.ru/", 404, '<a href="https://t.me/c">t</a>'),
            ("https://d.ru/", 200, '<a href="/contacts">c</a>'),
        ],
        "url string, status int, html string",
    )
    sites = spark.createDataFrame([("https://a.ru",), ("https://a.ru",), ("https://b.ru",), ("https://c.ru",), ("https://d.ru",), ("https://e.ru",)], "site string")
    got = {r.site: r for r in scan_sites(sites, pages).collect()}
    assert set(got) == {"https://a.ru", "https://b.ru", "https://d.ru"}
    assert got["https://a.ru"].messengers == {"vk": "https://vk.com/a", "telegram": "https://t.me/a", "whatsapp": "https://wa.me/7"}
    assert got["https://b.ru"].messengers == {"telegram": "https://t.me/b"} and got["https://b.ru"].has_marquiz
    assert got["https://a.ru"].cms == "wordpress" and got["https://d.ru"].messengers == {}


def test_verified_handles(spark):
    named = spark.createDataFrame([(1, "Мир Камня", None), (2, "Ритуал", "79031234567")], "id long, name string, phone string")
    page = '<div class="tgme_page_title">Памятники</div>'
    profiles = spark.createDataFrame(
        [("https://t.me/ritual_mirkamnya", page), ("https://t.me/mirkamnya_ritual", page), ("https://t.me/ritual", '<div class="tgme_page_title">x</div>')],
        "url string, html string",
    )
    found = verified_handles(handle_candidates(named), profiles).collect()
    assert [(r.id, r.url) for r in found] == [(1, "https://t.me/mirkamnya_ritual")]


def test_region_cities(spark):
    cities = spark.createDataFrame([("a", "R"), ("b", "R"), ("c", "S"), ("d", "S"), ("e", "")], "name string, region string")
    wanted = spark.createDataFrame([("a",), ("c",), ("e",), ("zz",)], "city string")
    towns = spark.createDataFrame([("R", "t1"), ("R", "t2")], "region string, town string")
    got = {(r.city, r.town) for r in region_cities(wanted, cities, towns).collect()}
    assert got == {("a", "t1"), ("a", "t2"), ("c", "c"), ("c", "d"), ("e", "e"), ("zz", "zz")}


def test_active_sources(spark):
    df = spark.createDataFrame([("a", None), ("b", True), ("c", False)], "source string, enabled boolean")
    assert {r.source for r in active_sources(df).collect()} == {"a", "b"}
    assert standard_active_sources({"yell": {"enabled": False}, "dgis": {}}) == ["jsprav", "firecrawl", "dgis", "firmsru"]


def test_localities_and_subdomains(spark):
    rows = [
        ("Камышин", 0, "Камышлов", None, "http://kamyishlov.dir.ru"),
        ("Камышин", 1, "Камышин", None, "http://kamyishin.dir.ru"),
        ("Волгоград", 0, "Волгоградский", None, "https://volgograd.dir.ru/x"),
        ("Орёл", 0, "Орёл-город", None, "http://orel.dir.ru"),
        ("Тверь", 0, "Москва", None, "http://moskva.dir.ru"),
        ("Тверь", 1, "Тверь-2", None, "http://tver2.dir.ru"),
    ]
    found = best_localities(spark.createDataFrame(rows, "city string, pos int, name string, region string, url string"))
    assert {r.city: r.pos for r in found.collect()} == {"Камышин": 1, "Волгоград": 0, "Орёл": 0}
    cities = spark.createDataFrame([(c,) for c in ("Камышин", "Волгоград", "Тверь", "Старый Русский")], "city string")
    known = spark.createDataFrame([("Волгоград", "volga1")], "city string, subdomain string")
    resolved = resolve_subdomains(cities, known, found, "dir.ru")
    subdomains = {r.city: r.subdomain for r in resolved.collect()}
    assert subdomains == {"Камышин": "kamyishin", "Волгоград": "volga1", "Тверь": "tver", "Старый Русский": "staryy-russkij"}
    pages = spark.createDataFrame([("https://volga1.dir.ru/works/", 200), ("https://tver.dir.ru/works/", 404)], "url string, status int")
    assert [r.city for r in known_categories(resolved, pages, "dir.ru", "works").collect()] == ["Волгоград"]


def test_listing_urls(spark):
    cities = spark.createDataFrame([("Тверь",), ("Москва",)], "city string")
    paths = spark.createDataFrame([("Москва", "/c/one/"), ("Москва", "/c/two")], "city string, path string")
    got = {(r.city, r.url) for r in listing_urls(cities, "https://d.ru", "/{city}/works/", paths).collect()}
    assert got == {("Тверь", "https://d.ru/tver/works/"), ("Москва", "https://d.ru/c/one"), ("Москва", "https://d.ru/c/two")}


def test_stages_and_gaps(spark):
    cities = spark.createDataFrame([(c,) for c in "abcd"], "city string")
    rows = lambda text: spark.createDataFrame([(c,) for c in text], "city string")
    got = {r.city: r.stage for r in stage_by_city(cities, rows("abbc"), rows("ab"), rows("a")).collect()}
    assert got == {"a": "enriched", "b": "deduped", "c": "scraped", "d": "start"}
    listed = spark.createDataFrame([("x",), ("x",), ("z",)], "category string")
    declared = spark.createDataFrame([("x", 2, 9), ("x", 1, 5), ("y", 1, 3), ("z", 1, None)], "category string, page int, total int")
    gaps = {r.category: (r.collected, r.declared, r.missing) for r in collection_gaps(listed, declared).collect()}
    assert gaps == {"x": (2, 5, 3), "y": (0, 3, 3), "z": (1, None, 0)}


def test_the_phone_is_the_first_handle(spark):
    companies = spark.createDataFrame(
        [(1, "Stone Works", "79001112233"), (2, "Stone Works", "79004445566"), (3, "Other Name", None)], "id long, name string, phone string"
    )
    relevant = '<div class="tgme_page_title">памятники</div>'
    profiles = spark.createDataFrame(
        [
            ("https://t.me/+79001112233", "Telegram: Contact"),
            ("https://t.me/+79004445566", "nothing"),
            ("https://t.me/stoneworks", relevant),
        ],
        "url string, html string",
    )
    assert {(r.id, r.url) for r in found_handles(companies, profiles).collect()} == {(1, "https://t.me/+79001112233"), (2, "https://t.me/stoneworks")}


def test_pages_are_read_once_and_never_shuffled(spark):
    sites = spark.createDataFrame([("https://a.ru",)], "site string")
    pages = spark.createDataFrame([("https://a.ru/", 200, "<p>bitrix</p>")], "url string, status int, html string")
    plan = scan_sites(sites, pages)._jdf.queryExecution().toString()
    assert "html" not in plan and plan.count("FileScan parquet") >= 3


def test_one_row_of_details_per_page(spark):
    schema = "url string, emails array<string>, phones array<string>, messengers map<string,string>, cms string"
    rows = [("u", ["a@b.c"], [], {}, "unknown"), ("u", ["a@b.c"], ["1"], {"vk": "v"}, "tilda"), ("u", ["a@b.c"], ["1"], {"vk": "v"}, "tilda"), ("w", None, None, None, None)]
    found = {r.url: r for r in one_per_page(spark.createDataFrame(rows, schema)).collect()}
    assert len(found) == 2 and found["u"].cms == "tilda" and found["u"].phones == ["1"] and found["w"].emails is None


def test_a_preset_that_cannot_be_read_is_an_error(spark):
    rows = table(spark, company(1, "Один", [], None, [], "Т", {}))
    with pytest.raises(Exception, match="PARSE|SYNTAX"):
        apply_preset(rows, "crm_score >= ")
    assert apply_preset(rows, "1=0").count() == 0 and apply_preset(rows, "no_such > 1").count() == 1
