import random
import string
from urllib.parse import urljoin

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollcall.functions.emails import emails_in_text, is_valid_email, valid_emails
from rollcall.functions.handles import candidate_handles
from rollcall.functions.phones import is_valid_phone, normalize_phone, normalize_phones, phones_in_text, strip_separators
from rollcall.functions.places import geo_point, is_local
from rollcall.functions.similarity import common_length, names_match
from rollcall.functions.texts import escape_markdown, file_name, longest, slugify, street_of, variant_label
from rollcall.functions.urls import clean_website, domain_of, is_internal_url, page_number, resolve_link


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("+79031234567", "79031234567"),
        ("89031234567", "79031234567"),
        ("+7 (903) 123-45-67", "79031234567"),
        ("9031234567", "79031234567"),
        ("", None),
        ("abc", None),
        ("123", None),
        ("+1 903 123 45 67", None),
    ],
)
def test_phone(value, raw, expected):
    assert value(normalize_phone(F.lit(raw))) == expected


def test_phone_of_another_country(value):
    assert value(normalize_phone(F.lit("+1 (743) 555-3824"), country="1", trunk="")) == "17435553824"


def test_phone_lists(value):
    numbers = F.array(*[F.lit(x) for x in ("+79031234567", "bad", "89031234567", "79032222222")])
    assert value(normalize_phones(numbers)) == ["79031234567", "79032222222"]
    assert value(normalize_phones(F.lit(None).cast("array<string>"))) == []
    assert [value(is_valid_phone(F.lit(x))) for x in ("79031234567", "7903123456", "")] == [True, False, False]
    assert value(strip_separators(F.lit("+7 (903) 123-45-67"))) == "+79031234567"
    assert value(phones_in_text(F.lit("call +7 (903) 123-45-67 or 89031234567"))) == ["+7 (903) 123-45-67"]


def test_emails(value):
    assert value(emails_in_text(F.lit("Contact: info@site.ru, info@site.ru a@b.com"))) == ["a@b.com", "info@site.ru"]
    assert value(emails_in_text(F.lit(None).cast("string"))) == []
    assert value(emails_in_text(F.lit("no address"))) == []
    listed = F.array(F.lit("a@b.ru"), F.lit("a@b.ru"), F.lit("no"), F.lit(" c@d.com"))
    assert value(valid_emails(listed)) == ["a@b.ru", " c@d.com"]
    assert value(is_valid_email(F.lit("a@b"))) is False


@pytest.mark.parametrize(
    "url, expected, literal",
    [
        ("https://site.ru/page", "site.ru", "site.ru"),
        ("www.site.ru", "site.ru", "site.ru"),
        ("HTTP://WWW.Site.ru:8080?x", "site.ru:8080", "site.ru:8080"),
        ("https://my.www.site.ru", "my.www.site.ru", "my.site.ru"),
        ("", None, None),
        (None, None, None),
    ],
)
def test_domain(value, url, expected, literal):
    assert value(domain_of(F.lit(url).cast("string"))) == expected
    assert value(domain_of(F.lit(url).cast("string"), literal=True)) == literal


@pytest.mark.parametrize(
    "url, internal",
    [
        ("http://localhost/x", True),
        ("http://127.0.0.1", True),
        ("http://10.1.2.3:80/", True),
        ("http://172.15.0.1", False),
        ("http://172.31.255.255", True),
        ("http://100.64.0.1", True),
        ("http://100.128.0.1", False),
        ("http://user:pw@192.168.1.1/", True),
        ("http://[::1]/", True),
        ("http://[fd00::1]:8080/", True),
        ("http://[febf::1]/", True),
        ("http://[2001:db8::1]/", False),
        ("http://8.8.8.8/", False),
        ("https://site.ru", False),
        ("https://10.1.2.3.ru", False),
        ("no scheme", True),
    ],
)
def test_internal_addresses(value, url, internal):
    assert value(is_internal_url(F.lit(url))) is internal


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("site.ru", "https://site.ru"),
        ("  http://site.ru/a b ", "http://site.ru/a"),
        ("-", None),
        ("N/A", None),
        ("", None),
        ("http://192.168.0.1", None),
        ("localhost", None),
    ],
)
def test_clean_website(value, raw, expected):
    assert value(clean_website(F.lit(raw))) == expected


def test_links_resolve_like_the_standard_library(spark):
    bases = ["http://h.ru/a/b", "http://h.ru", "https://h.ru/a/?q=1#t", "https://h.ru/x/y/z.html"]
    hrefs = ["c", "../c?x=1", "/x/./y/..", "//o.com/p", "?z=1", "mailto:x@y", "https://other.ru/p", "./k", "../../up", "a/../b"]
    pairs = [(b, h) for b in bases for h in hrefs]
    df = spark.createDataFrame(pairs, "base string, href string")
    for row in df.select("base", "href", resolve_link(F.col("base"), F.col("href")).alias("url")).collect():
        assert row.url == urljoin(row.base, row.href), row


@pytest.mark.parametrize("url, page", [("/x/page-3/", 3), ("/x?page=5", 5), ("/x/", 1), ("/page7", 7)])
def test_page_number(value, url, page):
    assert value(page_number(F.lit(url))) == page


def test_slugs_and_files(value):
    assert value(slugify(F.lit("Новый Город"))) == "novyy-gorod"
    assert value(slugify(F.lit(" Щёлково (МО)! "))) == "shchyolkovo-mo"
    assert value(slugify(F.lit("Подъезд объявлений"))) == "podezd-obyavleniy"
    assert value(file_name(F.lit("../Etc Passwd"))) == "etc_passwd"
    assert value(file_name(F.lit(""))) == "unnamed"
    assert value(escape_markdown(F.lit("a|b [c](d)"))) == r"a\|b \[c\]\(d\)"


@pytest.mark.parametrize(
    "address, street",
    [
        ("г. Тверь, ул. Ленина, 45", "ленина"),
        ("Тверь, проспект Маркса 12", "маркса"),
        ("город Тверь, пер. Новый, 1", "новый"),
        ("Тверь, Лесная", "тверь"),
        ("Лесная 5", "лесная 5"),
        ("", ""),
    ],
)
def test_street(value, address, street):
    assert value(street_of(F.lit(address))) == street


def test_longest_value(value):
    assert value(longest(F.lit("ab"), F.lit(" abcd "), F.lit("wxyz"))) == "abcd"
    assert value(longest(F.lit(""), F.lit(None).cast("string"))) == ""


def test_variant_labels(spark):
    def label(i):
        text = ""
        i += 1
        while i:
            i, rest = divmod(i - 1, 26)
            text = string.ascii_uppercase[rest] + text
        return text

    for row in spark.range(0, 20000).select("id", variant_label(F.col("id")).alias("v")).collect():
        assert row.v == label(row.id)


def test_places(value):
    city = F.lit("Астрахань")
    checks = {"Астрахань": True, "Москва": False, "": True, "Астрахани": True, "Астра": True}
    for locality, expected in checks.items():
        assert value(is_local(F.lit(locality), city)) is expected, locality
    assert value(is_local(F.lit(None).cast("string"), city)) is True
    assert value(geo_point(F.lit("46.35"), F.lit("48.03"))).asDict() == {"lat": 46.35, "lon": 48.03}
    assert value(geo_point(F.lit("0"), F.lit("48.03"))) is None
    assert value(geo_point(F.lit("north"), F.lit("48.03"))) is None


def test_handles(value):
    assert value(candidate_handles(F.lit(""), F.lit("79031234567"))) == []
    found = value(candidate_handles(F.lit("Ритуальные услуги Мир"), F.lit("79031234567")))
    assert found == [
        "ritualnyeuslugimir",
        "ritualmir",
        "ritualnyeuslugimir_ritual",
        "ritual_ritualnyeuslugimir",
        "ritualnyeuslugi4567",
        "79031234567",
    ]
    assert all(len(handle) >= 5 for handle in value(candidate_handles(F.lit("Mir"), F.lit(None).cast("string"))))


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(row[j + 1], new[-1], row[j] + (x == y)))
        row = new
    return row[-1]


def test_common_subsequence_of_short_and_long_texts(spark):
    random.seed(5)
    texts = ["".join(random.choice("abcdж ") for _ in range(random.choice([1, 5, 30, 62, 63, 90]))) for _ in range(60)]
    pairs = [(random.choice(texts), random.choice(texts)) for _ in range(150)]
    df = spark.createDataFrame(pairs, "a string, b string")
    for row in df.select("a", "b", common_length(F.col("a"), F.col("b")).alias("n")).collect():
        assert row.n == common(row.a, row.b)


@pytest.mark.parametrize(
    "a, b, threshold, same",
    [
        ("Камень", "Камень", 88, True),
        ("Камень", "камень ", 88, True),
        ("Мастер Иванов", "Иванов Мастер", 85, True),
        ("Камень-Мастер", "Мир Окон", 88, False),
        ("", "Камень", 88, False),
        ("marble llc master", "marble master", 86, True),
        ("marble llc master", "marble master", 87, False),
    ],
)
def test_name_similarity(value, a, b, threshold, same):
    assert value(names_match(F.lit(a), F.lit(b), threshold)) is same


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="0123456789+-() ", max_size=16), min_size=1, max_size=8))
def test_normalised_phones_are_stable(spark, raw):
    df = spark.createDataFrame([(raw,)], "phones array<string>")
    once = df.select(normalize_phones(F.col("phones")).alias("phones"))
    twice = once.select(normalize_phones(F.col("phones")).alias("phones"))
    found = once.first()["phones"]
    assert found == twice.first()["phones"]
    assert all(len(p) == 11 and p[0] == "7" for p in found) and len(set(found)) == len(found)
