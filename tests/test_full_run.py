"""The whole run against a plain Python reading of the same rules, on a small fixture."""

import random
import re

from pyspark.sql import functions as F

from rollcall.plans.commands import INPUTS, Workspace
from rollcall.plans.full_run import Rules, run
from rollcall.settings import LEVELS, WEIGHTS
from rollcall.sinks.reports import read_csv, read_further
from tests.test_grouping import listing, roots_by_union_find
from tests.test_grouping import table as listing_table

PAGE = '<script type="application/ld+json">{"@type": "ItemList", "itemListElement": [{"item": {"@type": "LocalBusiness", "name": "Новая"}}]}</script>'
TELEGRAM_PAGE = '<div class="tgme_page_title">Памятники</div><img class="tgme_page_photo_image">'


def world(size=120, seed=4):
    random.seed(seed)
    listings, pages, profiles, hits, details = [], [], [], [], []
    for i in range(size):
        city = f"c{i % 3}"
        phones = [f"8900{random.randrange(70):07d}" for _ in range(random.randrange(3))]
        site = random.choice([None, f"https://s{random.randrange(50)}.ru", "-", "localhost", f"www.s{random.randrange(50)}.ru/x"])
        emails = [f"m{random.randrange(40)}@x.ru"] if random.random() < 0.4 else []
        links = {"vk": f"v{i}"} if random.random() < 0.2 else {}
        if random.random() < 0.2:
            links["telegram"] = f"https://t.me/shop{i}"
        name = random.choice(["Мир", "Камень", "Stone Works", "Память"]) + f" {random.randrange(30)}"
        listings.append(listing(i, name, phones, site, emails, f"г. X, ул. {random.choice(['А', 'Б'])}, 1", links, city))
        profiles.append((f"https://t.me/shop{i}", '<div class="tgme_page_description">d</div>' if i % 2 else ""))
    for n in range(50):
        body = random.choice(["bitrix ", "wp-content ", "", "marquiz.ru "]) + random.choice(
            ["", f'<a href="https://t.me/shop{n}">t</a>', f'<a href="https://wa.me/7{n}">w</a>', f'<a href="https://vk.com/s{n}">v</a>']
        )
        pages.append((f"https://s{n}.ru/", 200 if n % 6 else 500, body))
    for name in {row[3] for row in listings}:
        handle = "ritual_" + re.sub(r"[^a-z0-9]", "", name.lower().replace("мир", "mir").replace("камень", "kamen").replace("память", "pamyat"))
        if random.random() < 0.4:
            profiles.append((f"https://t.me/{handle}", TELEGRAM_PAGE))
        for c in range(3):
            for pos in range(2):
                url = f"https://f{sum(map(ord, name))}-{len(name)}-{c}-{pos}.ru"
                hits.append((f"c{c}", name, pos, url, random.choice(["Другое", name.upper()])))
                details.append((url, [f"d{pos}@x.ru"], [f"+7 901 000-{c}{pos}-11", "bad"], {"telegram": f"https://t.me/d{c}"} if c else {}, random.choice(["tilda", "unknown"])))
    details = list({d[0]: d for d in details}.values())
    return listings, pages, profiles, hits, details


def normal(phone):
    digits = re.sub(r"\D", "", phone)
    if len(digits) == 11 and digits[0] == "8":
        digits = "7" + digits[1:]
    elif len(digits) == 10:
        digits = "7" + digits
    return digits if len(digits) == 11 and digits[0] == "7" else None


def host(site):
    if not site:
        return None
    return re.sub(r"^www\.", "", re.sub(r"^https?://", "", site).split("/")[0]) or None


def once(values):
    return list(dict.fromkeys(v for v in values if v))


def expected_companies(listings, pages, profiles, hits, details, rank_titles=False):
    rows = {r[0]: r for r in listings}
    keys = {}
    for r in listings:
        for key in [("p", normal(p)) for p in r[4] if normal(p)] + ([("s", host(r[6]))] if host(r[6]) else []):
            keys.setdefault((r[10], key), []).append(r[0])
    edges = [(ids[0], other) for ids in keys.values() for other in ids]
    roots = {i: i for i in rows} | roots_by_union_find(edges)
    groups = {}
    for i in sorted(rows):
        groups.setdefault(roots[i], []).append(rows[i])
    pages = {url.rstrip("/"): html for url, status, html in pages if status == 200}
    profiles = dict(profiles)
    details = {d[0]: d for d in details}
    out = {}
    for root, members in groups.items():
        best = lambda column: max((m[column] for m in members if m[column]), key=len, default=None)
        site = best(6)
        site = None if site in (None, "-", "localhost") else site if site.startswith("http") else "https://" + site
        links = {}
        for m in members:
            for kind, link in m[9].items():
                links.setdefault(kind, link)
        cms, quiz = "unknown", False
        html = pages.get(site.rstrip("/")) if site else None
        if html is not None:
            for kind, pattern in (("telegram", r'"(https://t\.me/[^"]+)"'), ("whatsapp", r'"(https://wa\.me/[^"]+)"'), ("vk", r'"(https://vk\.com/[^"]+)"')):
                found = re.search(pattern, html)
                if found:
                    links.setdefault(kind, found.group(1))
            cms = "wordpress" if "wp-content" in html else "bitrix" if "bitrix" in html else "unknown"
            quiz = "marquiz.ru" in html
        phones = once(normal(p) for m in members for p in m[4])
        emails = once(e for m in members for e in m[7])
        name = best(3)
        if "telegram" not in links:
            latin = re.sub(r"[^a-z0-9]", "", name.lower().replace("мир", "mir").replace("камень", "kamen").replace("память", "pamyat"))
            page = profiles.get(f"https://t.me/ritual_{latin}")
            if page == TELEGRAM_PAGE:
                links["telegram"] = f"https://t.me/ritual_{latin}"
        page = profiles.get(links.get("telegram"))
        trust = None if page is None else 1 if page else 0
        if not site or not emails:
            own = sorted(h for h in hits if h[0] == members[0][10] and h[1] == name)
            words = [w for w in name.lower().split()[:3] if len(w) > 2]
            named = [h for h in own if any(w in h[4].lower() for w in words)]
            chosen = ((rank_titles and named) or own)[0][3]
            _, more_emails, more_phones, more_links, found_cms = details[chosen]
            site = site or chosen
            emails = once(emails + more_emails)
            phones = once(phones + [normal(p) for p in more_phones])
            for kind, link in more_links.items():
                links.setdefault(kind, link)
            if cms == "unknown":
                cms = found_cms
        out[root] = dict(city=members[0][10], name=name, site=site, phones=phones, emails=emails, links=links, cms=cms, quiz=quiz, trust=trust, ids=[m[0] for m in members])
    counts = {}
    for c in out.values():
        for key in [("p", p) for p in c["phones"]] + ([("s", host(c["site"]))] if c["site"] else []):
            counts[(c["city"], key)] = counts.get((c["city"], key), 0) + 1
    for c in out.values():
        own = [("p", p) for p in c["phones"]] + ([("s", host(c["site"]))] if c["site"] else [])
        c["network"] = any(counts[(c["city"], key)] > 1 for key in own)
        score = 0
        if c["site"]:
            score += WEIGHTS["has_website"] + c["quiz"] * WEIGHTS["has_marquiz"]
            score += WEIGHTS["cms_bitrix"] if c["cms"] == "bitrix" else WEIGHTS["cms_modern"] if c["cms"] in ("wordpress", "tilda") else 0
        if c["links"].get("telegram"):
            score += WEIGHTS["has_telegram"] + (c["trust"] or 0) * WEIGHTS["tg_trust_multiplier"]
        score += bool(c["links"].get("whatsapp")) * WEIGHTS["has_whatsapp"] + (len(c["phones"]) > 1) * WEIGHTS["multiple_phones"]
        score += bool(c["emails"]) * WEIGHTS["has_email"] + c["network"] * WEIGHTS["is_network"]
        c["score"] = score
        c["segment"] = next((s for s in "ABC" if score >= LEVELS[f"segment_{s}"]), "D")
    return out


def frames(spark, parts):
    listings, *inputs = parts
    return listing_table(spark, listings), {name: spark.createDataFrame(rows, INPUTS[name]) for name, rows in zip(INPUTS, inputs)}


def as_dict(rows):
    return {
        r.id: dict(
            city=r.city,
            name=r["name"],
            site=r.website,
            phones=r.phones,
            emails=r.emails,
            links=r.messengers,
            cms=r.cms,
            quiz=r.has_marquiz,
            trust=r.tg_trust and r.tg_trust.trust_score,
            ids=r.merged_from,
            network=r.is_network,
            score=r.crm_score,
            segment=r.segment,
        )
        for r in rows
    }


def test_run_equals_plain_python(spark):
    parts = world()
    listings, inputs = frames(spark, parts)
    for rank_titles in (False, True):
        got = as_dict(run(listings, **inputs, rules=Rules(rank_titles=rank_titles)).companies.collect())
        expected = expected_companies(*parts, rank_titles=rank_titles)
        assert got.keys() == expected.keys()
        for id, company in expected.items():
            assert got[id] == company, id


def test_workspace(spark, tmp_path):
    parts = world(60, seed=9)
    listings, inputs = frames(spark, parts)
    root = str(tmp_path / "w")
    stamped = listings.withColumns(
        {"source_url": F.concat(F.lit("https://u/"), F.col("id").cast("string")), "scraped_at": F.timestamp_seconds(F.lit(1_700_000_000))}
    )
    stamped.where("id < 40").write.parquet(f"{root}/incoming")
    for name, df in inputs.items():
        df.write.parquet(f"{root}/{name}")
    work = Workspace(spark, root)
    assert work.export() is None and work.run("all", no_scrape=True) == []
    assert work.run() == ["c0", "c1", "c2"]
    first = as_dict(work.companies.read().collect())
    assert first == expected_companies(parts[0][:40], *parts[1:])
    assert {r.stage for r in work.stages().collect()} == {"enriched"}
    work.companies.delete_scopes(["c2"])
    assert {r.city: r.stage for r in work.stages().collect()} == {"c0": "enriched", "c1": "enriched", "c2": "deduped"}
    work.run("c2", no_scrape=True)
    assert as_dict(work.companies.read().collect()) == first

    stamped.where("id >= 40").write.mode("append").parquet(f"{root}/incoming")
    work.run("c1")
    second = as_dict(work.companies.read().collect())
    assert {i: c for i, c in second.items() if c["city"] != "c1"} == {i: c for i, c in first.items() if c["city"] != "c1"}
    assert sorted(i for c in second.values() if c["city"] == "c1" for i in c["ids"]) == [i for i in range(60) if i % 3 == 1]

    work.run("all", no_scrape=True)
    joined = {r.id: r.entity for r in work.labelled.read().collect()}
    assert joined.keys() == set(range(60))

    work.run("all", force=True, no_scrape=True)
    assert {r.id: r.entity for r in work.labelled.read().collect()} == joined
    whole = as_dict(work.companies.read().collect())
    assert whole == expected_companies(*parts)

    work.run("all", re_enrich=True)
    again = as_dict(work.companies.read().collect())
    assert again.keys() == whole.keys() and all(again[i]["ids"] == whole[i]["ids"] for i in whole)

    assert spark.read.csv(work.export(), header=True).count() == len(whole)
    assert work.export("c1", format="md").endswith("report")
    path = work.export_preset("with_telegram", "c2")
    wanted = [c for c in again.values() if c["city"] == "c2" and "telegram" in c["links"]]
    assert spark.read.csv(path, header=True).count() == len(wanted)
    done = work.export_everything("c0")
    assert set(done) >= {"enriched", "full_dump", "conflicts"} and not any(p.startswith("error") for p in done.values())
    assert {r.city for r in read_csv(spark, f"{root}/export/enriched").select("city").distinct().collect()} == {"c0", "c1", "c2"}
    review = sum(c["city"] == "c0" for c in as_dict(work.companies.read().where("needs_review").collect()).values())
    lines = [r.value for r in spark.read.text(done["conflicts"]).where("city = 'c0'").collect()]
    assert f"**Найдено конфликтов:** {review}" in lines

    source = spark.createDataFrame([("c", "c9", 1, "u", PAGE)], "category string, city string, page int, url string, html string")
    source.write.parquet(f"{root}/sources/jsprav")
    for _ in range(2):
        assert work.collect() == {}
        assert [(r.id, r["name"]) for r in work.raw.read(["c9"]).collect()] == [(60, "Новая")]
    assert "Новая" in {r["name"] for r in work.companies.read(work.run("c9")).collect()}
    work.clear("c9")

    work.clear("c0")
    assert work.companies.scopes() == ["c1", "c2"] and work.raw.scopes() == ["c1", "c2"]


def test_exports_hold_every_value_of_a_company(spark, tmp_path):
    root = str(tmp_path / "w")
    many = [f"8903{i:07d}" for i in range(7)]
    rows = [listing(1, "Много", many[:4], city="A"), listing(2, "Много", many[3:], city="A"), listing(3, "Мало", ["89990000000"], city="B")]
    stamped = listing_table(spark, rows).withColumns({"source_url": F.col("id").cast("string"), "scraped_at": F.timestamp_seconds(F.lit(1_700_000_000))})
    stamped.write.parquet(f"{root}/incoming")
    work = Workspace(spark, root, Rules(listed=2))
    work.run(export=True)
    phones = [f"7903{i:07d}" for i in range(7)]

    def beside(name):
        return [(r.city, r.id, r.kind, r.place, r.value) for r in read_further(spark, f"{root}/export/{name}").orderBy("kind", "place").collect()]

    expected = [("A", 1, "phone", n, phones[n - 1]) for n in range(3, 8)]
    assert {r.id: r.phones for r in read_csv(spark, f"{root}/export/enriched").collect()} == {"1": "; ".join(phones[:2]), "3": "79990000000"}
    assert beside("enriched") == expected and beside("manual_search") == expected and beside("full_dump") == expected
    assert beside("with_telegram") == []
    wide = Workspace(spark, root, Rules(listed=9))
    wide.run(force=True, no_scrape=True)
    wide.export()
    assert beside("enriched") == [] and beside("manual_search") == expected
    assert read_csv(spark, f"{root}/export/enriched").where("id = '1'").first().phones == "; ".join(phones)


def test_a_run_lists_every_value_of_a_large_company(spark):
    n = 10_050
    rows = spark.range(n).selectExpr("id", "array('89031234567', concat('8904', lpad(CAST(id AS string), 7, '0'))) AS phones", "'Много' AS name", "'A' AS city")
    listings = listing_table(spark, []).unionByName(rows, allowMissingColumns=True)
    inputs = {name: spark.createDataFrame([], schema) for name, schema in INPUTS.items() if name != "fetched"}
    inputs["hits"] = inputs["hits"].select("city", "query_name", "pos", "url", "title")
    (row,) = run(listings, **inputs).companies.select("id", "phones", "merged_from", "n_phones").collect()
    assert row.merged_from == list(range(n)) and row.n_phones == n + 1
    assert row.phones == ["79031234567"] + [f"7904{i:07d}" for i in range(n)]
