import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rollcall.functions.similarity import common_length, least_distance, letter_bits
from rollcall.operators.linkage import clean_contacts, clusters_by_key, connected_components, phone_links, shared_domains, site_links, star_edges
from rollcall.operators.merge import EMAIL, LISTING, PHONE, PIECE, extend_entities, extended_links, further_values, nest, resolve_entities
from rollcall.operators import name_pairs
from rollcall.operators.name_pairs import candidate_pairs, name_edges, name_groups, similar_name_pairs
from rollcall.operators.picking import first_per_key, numbered, with_dense_ids
from rollcall.schema import LISTING as LISTING_SCHEMA


def listing(id, name="shop", phones=(), website=None, emails=(), address="", messengers=None, city="T"):
    return (id, "src", "", name, list(phones), address, website, list(emails), None, messengers or {}, city, None)


def table(spark, rows):
    return spark.createDataFrame(rows, LISTING_SCHEMA)


def roots_by_union_find(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def components(spark, edges):
    df = spark.createDataFrame(edges, "hi long, lo long")
    return {row.id: row.root for row in connected_components(df).df.collect()}


def check_components(spark, edges):
    expected = {x: root for x, root in roots_by_union_find(edges).items() if x != root}
    assert components(spark, edges) == expected


def test_chain_star_and_random_graphs(spark):
    check_components(spark, [(i, i + 1) for i in range(60)])
    check_components(spark, [(i, 1000 - i) for i in range(400)])
    check_components(spark, [(500, i) for i in range(1, 500)])
    random.seed(11)
    shuffled = random.sample(range(10_000), 300)
    check_components(spark, list(zip(shuffled, shuffled[1:])))
    check_components(spark, [(random.randrange(400), random.randrange(400)) for _ in range(330)])


def test_edges_may_point_either_way_and_at_themselves(spark):
    assert components(spark, [(1, 2), (2, 1), (3, 3), (5, 4)]) == {2: 1, 5: 4}


def test_a_shared_key_gives_one_edge_per_holder(spark):
    links = spark.createDataFrame([("T", "p:1", i) for i in range(200)], "city string, key string, id long")
    assert star_edges(links).count() == 199


def grouped(rows):
    found = {}
    for row in rows:
        found.setdefault(row.cluster, set()).add(row.id)
    return sorted(map(sorted, found.values()))


def test_phone_clusters(spark):
    rows = [listing(1, phones=["a"]), listing(2, phones=["a", "b"]), listing(3, phones=["b"]), listing(4, phones=["c"]), listing(5)]
    df = table(spark, rows)
    assert grouped(clusters_by_key(df, phone_links(df)).collect()) == [[1, 2, 3]]


def test_site_clusters(spark):
    rows = [
        listing(1, website="https://site.ru/a"),
        listing(2, website="www.site.ru"),
        listing(3, website="https://other.ru"),
        listing(4, website="site.ru", city="U"),
        listing(5),
    ]
    df = table(spark, rows)
    assert grouped(clusters_by_key(df, site_links(df)).collect()) == [[1, 2]]
    assert grouped(shared_domains(df).collect()) == [[1, 2]]
    assert shared_domains(df, scope=()).count() == 3


def test_merge_keeps_the_best_of_each_group(spark):
    rows = [
        listing(1, "Мир", ["89031234567"], "site.ru", ["a@b.ru"], "г. Тверь, ул. Ленина, 1", {"vk": "v1"}),
        listing(2, "Мир Камня", ["+79031234567", "9032222222"], None, ["c@d.ru", "bad"], "г. Тверь, ул. Маркса, 10", {"vk": "v2", "telegram": "t2"}),
        listing(3, "Один", [], "", [], "", {"vk": ""}),
    ]
    resolved = resolve_entities(table(spark, rows))
    merged = {row.id: row for row in nest(resolved.companies, resolved.facts).collect()}
    assert set(merged) == {1, 3}
    one = merged[1]
    assert one.name_best == "Мир Камня" and one.phones == ["79031234567", "79032222222"]
    assert one.emails == ["a@b.ru", "c@d.ru"] and one.website == "site.ru" and one.merged_from == [1, 2]
    assert one.messengers == {"vk": "v1", "telegram": "t2"} and one.needs_review
    assert one.review_reason == "same_name_diff_address" and one.address == "г. Тверь, ул. Маркса, 10"
    three = merged[3]
    assert three.website is None and three.messengers == {} and not three.needs_review and three.phones == []


def test_ties_go_to_the_lowest_id(spark):
    rows = [listing(7, "bb", ["89031234567"]), listing(3, "aa", ["89031234567"]), listing(9, "cc", ["89031234567"])]
    assert resolve_entities(table(spark, rows)).companies.first().name_best == "aa"


def test_row_order_does_not_matter_and_every_listing_is_in_one_group(spark):
    random.seed(2)
    rows = [
        listing(i, f"n{i % 7}", [f"8900000{random.randrange(60):04d}"], f"s{random.randrange(40)}.ru" if i % 3 == 0 else None, city=f"c{i % 3}")
        for i in range(200)
    ]
    first = resolve_entities(table(spark, rows))
    second = resolve_entities(table(spark, random.sample(rows, len(rows))).repartition(7))
    key = lambda r: (r.id, r.n_listings, r.name_best, r.n_phones, r.website)
    assert sorted(map(key, first.companies.collect()), key=str) == sorted(map(key, second.companies.collect()), key=str)
    assert sorted(r.listing_id for r in first.members.collect()) == list(range(200))


def labels(resolved):
    return sorted((tuple(r) for r in resolved.labelled.select("id", "entity", "city", "name", "phones", "website").collect()), key=str)


def test_further_listings_join_stored_companies(spark):
    random.seed(5)
    ids = random.sample(range(1000), 240)
    rows = [
        listing(i, f"n{i % 7}", [f"8900000{random.randrange(110):04d}" for _ in range(random.randrange(3))], f"s{random.randrange(90)}.ru" if i % 4 == 0 else None, city=f"c{i % 3}")
        for i in ids
    ]
    resolved = resolve_entities(table(spark, rows[:100]))
    for upto in (130, 240):
        # Every batch holds the listings before it as well, some with lower ids than any of them.
        resolved = extend_entities(resolved.labelled, table(spark, rows[:upto]))
        assert labels(resolved) == labels(resolve_entities(table(spark, rows[:upto])))
    assert labels(extend_entities(resolved.labelled, table(spark, []))) == labels(resolved)


def test_a_late_listing_joins_two_companies_and_lowers_their_id(spark):
    old = [listing(5, phones=["89031234567"]), listing(6, phones=["89031234567"]), listing(7, website="a.ru"), listing(8, website="a.ru"), listing(9, phones=["89031234567"], city="U")]
    late = [listing(2, phones=["+7 903 123-45-67"], website="https://www.a.ru/x")]
    resolved = extend_entities(resolve_entities(table(spark, old)).labelled, table(spark, late))
    assert {r.id: r.entity for r in resolved.labelled.collect()} == {2: 2, 5: 2, 6: 2, 7: 2, 8: 2, 9: 9}
    assert {r.id: r.n_listings for r in resolved.companies.collect()} == {2: 5, 9: 1}


def test_only_companies_that_share_a_key_are_linked_anew(spark):
    old = [listing(i, phones=["89031234567", f"8904{i:07d}"], website="portal.ru") for i in range(300)] + [listing(i, phones=[f"8905{i:07d}"]) for i in range(300, 900)]
    late = clean_contacts(table(spark, [listing(1000, phones=["89031234567"], website="portal.ru"), listing(1001, phones=["89050000300"])]))
    links = extended_links(resolve_entities(table(spark, old)).labelled, late)
    assert sorted((r.key, r.id) for r in links.collect()) == [
        ("p:79031234567", 0), ("p:79031234567", 1000), ("p:79050000300", 300), ("p:79050000300", 1001), ("s:portal.ru", 0), ("s:portal.ru", 1000),
    ]


def test_a_group_that_holds_most_rows_is_kept_whole(spark):
    rows = [listing(i, f"n{i}", [f"8900{i:07d}"], "https://portal.ru/x") for i in range(700)] + [listing(1000 + i) for i in range(50)]
    resolved = resolve_entities(table(spark, rows))
    (row,) = nest(resolved.companies, resolved.facts, limit=100).where("id = 0").collect()
    assert (row.n_phones, row.n_listings) == (700, 700)
    assert row.phones == [f"7900{i:07d}" for i in range(100)] and row.merged_from == list(range(100))
    more = further_values(resolved.facts, limit=100).where("id = 0").collect()
    assert sorted(r.value for r in more if r.kind == PHONE) == [f"7900{i:07d}" for i in range(100, 700)]
    assert len(more) == 1200
    kinds = {r.kind: r["count"] for r in resolved.facts.groupBy("kind").count().collect()}
    assert kinds == {PHONE: 700, LISTING: 750} and EMAIL not in kinds


def test_lists_hold_all_values_however_many(spark):
    """More values than are sorted in one piece: the row of the company has all of them in first-seen order, also by default."""
    n = 2 * PIECE + 7
    facts = spark.range(n).selectExpr("1L AS id", "'phone' AS kind", "concat('79', lpad(id * 7919 % 1000003, 9, '0')) AS value", "id AS first_id", "0 AS pos")
    members = spark.range(n).selectExpr("1L AS id", "'listing' AS kind", "CAST(id AS string) AS value", "id AS first_id", "0 AS pos")
    few = spark.createDataFrame([(1, "email", "b@x.ru", 4, 0), (1, "email", "a@x.ru", 4, 1), (2, "phone", "7", 9, 0)], "id long, kind string, value string, first_id long, pos int")
    rows = {r.id: r for r in nest(spark.range(1, 4).toDF("id"), facts.unionByName(members).unionByName(few)).collect()}
    assert rows[1].phones == [f"79{i * 7919 % 1000003:09d}" for i in range(n)]
    assert rows[1].merged_from == list(range(n)) and rows[1].emails == ["b@x.ru", "a@x.ru"]
    assert (rows[2].phones, rows[2].emails, rows[2].merged_from) == (["7"], [], [])
    assert (rows[3].phones, rows[3].emails) == ([], [])
    assert further_values(facts).collect() == []


def test_shared_hosts_can_be_set_aside(spark):
    df = table(spark, [listing(1, website="vk.com/a"), listing(2, website="vk.com/b")])
    assert resolve_entities(df).companies.count() == 1
    assert resolve_entities(df, shared_hosts=("vk.com",)).companies.count() == 2


def test_similar_names_join_the_grouping(spark):
    df = table(spark, [listing(1, "Marble Master LLC"), listing(2, "Marble Master"), listing(3, "Other"), listing(4, "marble  MASTER")])
    assert similar_name_pairs(df, threshold=80).count() == 1
    edges = name_edges(df, threshold=80)
    groups = resolve_entities(df, extra_edges=edges).companies.select("n_listings").collect()
    assert sorted(r.n_listings for r in groups) == [1, 3]


def test_a_shared_phrase_is_no_join_key(spark):
    """Names that differ in more than the edits allowed do not meet by what they share."""
    random.seed(5)
    rest = ["".join(random.choices("abcdefghijklmnopqrstuvwxyz", k=14)) for _ in range(300)]
    df = spark.createDataFrame([(i, "A", f"granite workshop {r}") for i, r in enumerate(rest)], "id long, city string, name string")
    by_block = df.groupBy("city").count().first()["count"]
    looked_at = candidate_pairs(df.selectExpr("id", "city", "concat('g', name) AS name"), 88, block="first").count()
    assert by_block == 300 and looked_at < 300 * 299 / 2 / 5


def test_long_names(spark):
    random.seed(6)
    texts = ["".join(random.choices("abc d", k=n)) for n in (1, 61, 62, 63, 124, 125, 200) for _ in range(3)]
    rows = [(a, b) for a in texts for b in texts if a.strip() and b.strip()]
    got = spark.createDataFrame(rows, "a string, b string").select("a", "b", common_length(F.col("a"), F.col("b")).alias("n")).collect()
    assert all(r.n == common(r.a, r.b) for r in got) and len(got) == len(rows)


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(row[j + 1], new[-1], row[j] + (x == y)))
        row = new
    return row[-1]


def test_similar_pairs_equal_brute_force(spark):
    random.seed(3)
    words = ["alpha", "alfa", "stone", "stones", "ston", "work", "works", "shop", "llc", "beta", "betta", "x", "monument", "monumenty"]
    rows = [(i, "A" if i % 3 else "B", " ".join(random.choices(words, k=random.randint(1, 5)))) for i in range(160)]
    rows += [(900, "A", "abc" * 30 + " tail"), (901, "A", "abc" * 30 + " tali"), (902, "A", "abc" * 29 + "abd tail")]
    df = spark.createDataFrame(rows, "id long, city string, name string")
    for threshold, block in ((88, "first"), (75, "sorted")):
        lowest = {}
        for id, city, name in rows:
            text = " ".join(sorted(name.split()))
            key = (city, (text if block == "sorted" else name)[0], text)
            lowest[key] = min(lowest.get(key, 10**9), id)
        names, expected = list(lowest), set()
        for i, a in enumerate(names):
            for b in names[i + 1 :]:
                if a[:2] == b[:2]:
                    total = len(a[2]) + len(b[2])
                    distance = total - 2 * common(a[2], b[2])
                    if distance * 100 <= (100 - threshold) * total:
                        expected.add((*sorted((lowest[a], lowest[b])), distance))
        got = similar_name_pairs(df, threshold, block=block).collect()
        assert {(r.lo, r.hi, r.distance) for r in got} == expected and len(got) == len(expected)


        low = {lowest[n]: lowest[n] for n in names}
        for _ in names:
            for lo, hi, _ in expected:
                low[lo] = low[hi] = min(low[lo], low[hi])
        of = {id: low[lowest[(city, (text if block == "sorted" else name)[0], text)]] for id, city, name in rows for text in [" ".join(sorted(name.split()))]}
        found = name_groups(df, threshold, block=block).collect()
        assert {r.id: r.root for r in found} == of and len(found) == len(rows)


def test_alike_names_are_compared_in_proportion(spark, monkeypatch):
    """Names that differ in three digits: all pairs grow with the square, what is compared does not."""
    compared, linked = [], name_pairs._linked

    def counted(pairs, threshold):
        compared[-1] += pairs.count()
        return linked(pairs, threshold)

    monkeypatch.setattr(name_pairs, "_linked", counted)
    for n in (100, 400):
        compared.append(0)
        df = spark.createDataFrame([(i, "A", f"granite workshop number {i * 7 % 1000:03d}") for i in range(n)], "id long, city string, name string")
        assert {r.root for r in name_groups(df, 88).collect()} == {0}
    assert compared[0] <= 400 and compared[1] <= 6 * compared[0]


def test_letter_bits_are_a_lower_bound(spark):
    random.seed(8)
    texts = ["".join(random.choices("abcdeé 123Ж", k=random.randint(0, 30))) for _ in range(60)]
    rows = spark.createDataFrame([(a, b) for a in texts for b in texts], "text_a string, text_b string")
    bits = rows.select("text_a", "text_b", letter_bits(F.col("text_a")).alias("a"), letter_bits(F.col("text_b")).alias("b"))
    for r in bits.select("text_a", "text_b", least_distance("a", "b").alias("least")).collect():
        assert r.least <= len(r.text_a) + len(r.text_b) - 2 * common(r.text_a, r.text_b)


def test_first_row_and_numbering_within_a_key(spark):
    rows = [("hot" if i % 4 else f"k{i}", i * 37 % 1009, f"v{i}") for i in range(1000)]
    df = spark.createDataFrame(rows, "k string, o long, v string")
    expected_first, expected_number = {}, {}
    for k, o, v in sorted(rows, key=lambda r: r[1]):
        expected_first.setdefault(k, v)
        expected_number[(k, o)] = sum(1 for x in rows if x[0] == k and x[1] <= o)
    assert {r.k: r.v for r in first_per_key(df, ["k"], "o").collect()} == expected_first
    got = numbered(df, ["k"], "o", "n").collect()
    assert {(r.k, r.o): r.n for r in got} == expected_number
    assert numbered(df.where(F.lit(False)), ["k"], "o", "n").count() == 0


def test_dense_ids_depend_on_the_rows_only(spark):
    rows = [(f"n{i % 90}", [f"p{i}"], {"k": f"v{i}"}) for i in range(300)] + [("same", ["p"], {})] * 50
    df = spark.createDataFrame(rows, "name string, phones array<string>, links map<string,string>")
    one = with_dense_ids(df, start=7, buckets=16).collect()
    two = with_dense_ids(spark.createDataFrame(random.sample(rows, len(rows)), df.schema).repartition(5), start=7, buckets=16).collect()
    assert sorted(r.id for r in one) == list(range(7, 357))
    assert {(r.id, r.name, str(r.phones)) for r in one} == {(r.id, r.name, str(r.phones)) for r in two}


def test_similar_pairs_are_listed_without_a_shuffle_of_pairs(spark):
    """Between the check of the pairs and the join that finds them lies no exchange, so what is on disk does not grow with the pairs."""
    df = spark.createDataFrame([(i, "A", f"granite workshop number {i:03d}") for i in range(60)], "id long, city string, name string")
    pairs = similar_name_pairs(df, 88)
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("Join Inner, (((")]
    assert "MapInArrow" in above and "Aggregate" not in above and "Repartition" not in above
    found = pairs.collect()
    assert len(found) == len({(r.lo, r.hi) for r in found}) > 60


def test_names_meet_in_chunks(spark, monkeypatch):
    """What is joined are chunks of names, not names: alike names give far fewer joined rows than pairs, and each pair still once."""
    random.seed(12)
    texts = {f"granite workshop number {i:03d}" for i in range(300)}
    for n in (30, 80, 130):
        for _ in range(6):
            base = [chr(0x4E00 + random.randrange(300)) for _ in range(n)]
            for _ in range(4):
                places = random.sample(range(1, n), 2)
                texts.add("g" + "".join(random.choice("Ж😀b") if k in places else c for k, c in enumerate(base)))
    names = sorted(texts)
    df = spark.createDataFrame([(i, "A", t) for i, t in enumerate(names)], "id long, city string, name string")
    stored = [" ".join(sorted(t.lower().split())) for t in names]
    left, right = zip(*[(i, j) for i in range(len(names)) for j in range(i + 1, len(names))])
    distances = name_pairs.indel_distances(pa.array([stored[i] for i in left]), pa.array([stored[j] for j in right]))
    expected = {(i, j, d) for i, j, d in zip(left, right, distances.tolist()) if 100 * d <= 12 * (len(stored[i]) + len(stored[j]))}
    assert name_pairs._met(df, 88, ("city",), "first").count() < len(expected) / 20
    for chunk, together in ((128, 16), (7, 2)):
        monkeypatch.setattr(name_pairs, "_CHUNK", chunk)
        monkeypatch.setattr(name_pairs, "_TOGETHER", together)
        got = similar_name_pairs(df, 88).collect()
        assert {(r.lo, r.hi, r.distance) for r in got} == expected and len(got) == len(expected)
        assert all((r.text_lo, r.text_hi) == (stored[r.lo], stored[r.hi]) for r in got)


def test_rounds_over_names_broadcast_nothing(spark):
    """What a round joins grows with the names; none of it may go through the driver."""
    written, kept = [], name_pairs.keep

    def watched(df, label):
        if label in ("name-open", "name-links"):
            written.append(df._jdf.queryExecution().sparkPlan().toString())
        return kept(df, label)

    df = spark.createDataFrame([(i, "A", f"granite workshop number {i:03d}") for i in range(60)], "id long, city string, name string")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(name_pairs, "keep", watched)
        assert {r.root for r in name_groups(df, 88).collect()} == {0}
    assert written and not any("Broadcast" in plan for plan in written)


def test_distances_of_a_batch(spark):
    random.seed(9)
    texts = ["", "a", "Ж😀x", *["".join(random.choices("abcé 1", k=random.randint(0, 90))) for _ in range(40)]]
    pairs = [(a, b) for a in texts for b in texts]
    got = name_pairs.indel_distances(pa.array([a for a, _ in pairs]), pa.array([b for _, b in pairs]))
    assert got.tolist() == [len(a) + len(b) - 2 * common(a, b) for a, b in pairs]
