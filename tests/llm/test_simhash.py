import random

import xxhash

from rollcall.llm.simhash import covering_masks, fingerprint, fingerprint_links, simhash_components, without_near_copies

SCHEMA = "doc_id long, text string, bits string"


def plain(text, shingle=3):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    parts = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(ids, prints, radius=2):
    low = dict(enumerate(range(len(ids))))

    def find(i):
        while low[i] != i:
            i = low[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                a, b = find(i), find(j)
                low[max(a, b)] = min(a, b)
    groups = {}
    for i in range(len(ids)):
        groups.setdefault(find(i), []).append(ids[i])
    return [min(groups[find(i)]) for i in range(len(ids))]


def test_fingerprints_by_plain_code():
    for text in (None, "", " \t\n", "One", "one  TWO", "ÄÖ Äpfel É x y z", "a b c " * 9, "\x1c a \x85 b c d"):
        assert fingerprint(None if text is None else text.encode()) == plain(text)


def test_every_pair_in_the_radius_meets_in_a_table():
    draw = random.Random(1)
    for radius in (2, 4):
        masks = covering_masks(radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        for _ in range(2000):
            flips = sum(1 << b for b in draw.sample(range(64), radius))
            assert any(not flips & m for m in masks)


def test_components_equal_brute_force(spark):
    draw = random.Random(2)
    words = [f"w{i}" for i in range(40)]
    base = [" ".join(draw.choices(words, k=draw.randint(0, 60))) for _ in range(40)]
    texts = []
    for i in range(300):
        parts = draw.choice(base).split(" ")
        if i % 3 and parts:
            parts[draw.randrange(len(parts))] = draw.choice(words)
        texts.append(" ".join(parts))
    rows = [(1000 - i, t, "x") for i, t in enumerate(texts)] + [(2000, None, ""), (2001, "", ""), (2002, " \n", "")]
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash_components(spark.createDataFrame(rows, SCHEMA)).collect()}
    ids, prints = [r[0] for r in rows], [plain(r[1]) for r in rows]
    assert got == {i: (f"{p:016x}", c) for i, p, c in zip(ids, prints, components(ids, prints))}


def test_large_buckets_lose_no_link(spark):
    """Fingerprints crowded in one ball: the pairs of small buckets and the points of large ones link the same."""
    draw = random.Random(3)
    centre, prints = draw.getrandbits(64), set()
    while len(prints) < 400:
        prints.add(centre ^ sum(1 << b for b in set(draw.choices(range(64), k=draw.randint(0, 5)))))
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(s,) for s in signed], "bits long")
    expected = components(list(range(len(prints))), prints)
    for small in (1, 16, 1000):
        edges = [(r["hi"], r["lo"]) for r in fingerprint_links(frame, small=small).collect()]
        place = {s: i for i, s in enumerate(signed)}
        low = list(range(len(prints)))
        changed = True
        while changed:
            changed = False
            for a, b in edges:
                a, b = place[a], place[b]
                least = min(low[a], low[b])
                changed |= low[a] != low[b]
                low[a] = low[b] = least
        assert low == expected


def test_one_row_of_each_group_stays(spark):
    rows = [(3, "a b c d e", "x"), (1, "a b c d e", "y"), (1, "a b c d e", "z"), (7, "q r s t u v w", None), (9, None, ""), (8, "", "")]
    kept = without_near_copies(spark.createDataFrame(rows, SCHEMA))
    assert kept.columns == ["doc_id", "text", "bits"]
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 7, 8]


def test_null_ids_repeats_and_empty_table(spark):
    rows = [(None, "one two three four", ""), (4, "one two three four", ""), (4, "one two three four", ""), (None, "x y z", "")]
    got = sorted(((r["doc_id"], r["component_id"]) for r in simhash_components(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    assert got == [(4, 4), (4, 4), (None, 4), (None, None)]
    assert simhash_components(spark.createDataFrame([], SCHEMA)).collect() == []


def test_the_row_is_chosen_per_group_not_per_id(spark):
    """Different texts under null ids and under one id all stay; a null id goes where its group has another."""
    texts = [" ".join(f"{c}{i}" for i in range(9)) for c in "abcdef"]
    rows = [(None, texts[0], "n"), (None, texts[1], "n"), (None, texts[2], "n"), (5, texts[3], "x"), (5, texts[4], "x"), (None, texts[3], "copy"), (5, texts[3], "a"), (None, texts[0], "m")]
    kept = without_near_copies(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, [(None, texts[0], "m"), (None, texts[1], "n"), (None, texts[2], "n"), (5, texts[3], "a"), (5, texts[4], "x")]))


def test_texts_that_share_much_are_not_paired(spark):
    """Texts that share 70 % of their words meet by no rare shingle, those that share nearly all do."""
    from rollcall.llm.simhash import _meeting_by_rare_shingles

    draw = random.Random(9)
    words = [f"w{i}" for i in range(5000)]
    shared = draw.choices(words, k=140)
    texts = [shared + draw.choices(words, k=60) for _ in range(60)]
    texts += [t[:-1] + ["other"] for t in texts[:5]]
    rows = [(i, " ".join(t).encode(), len({tuple(t[k : k + 5]) for k in range(len(t) - 4)})) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "node long, text binary, size long")
    met = _meeting_by_rare_shingles(frame.select("node", "size", frame.node.alias("root")), frame, 5, 0.8).collect()
    assert {(r["node"], r["other"]) for r in met} >= {(60 + i, i) for i in range(5)} and len(met) < 60


def test_candidates_by_fingerprint_are_the_pairs_within_the_radius(spark):
    """The stage's first step: stars over equal and near fingerprints join what all pairs within 2 bits join."""
    from rollcall.llm.simhash import _by_fingerprint

    draw = random.Random(11)
    centres = [draw.getrandbits(64) for _ in range(30)]
    prints = [draw.choice(centres) ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 3))) for _ in range(200)]
    rows = [(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(prints)]
    low = list(range(len(prints)))
    pairs = [(r["node"], r["other"]) for r in _by_fingerprint(spark.createDataFrame(rows, "node long, bits long")).collect()]
    assert all(bin(prints[a] ^ prints[b]).count("1") <= 2 for a, b in pairs)
    for _ in rows:
        for a, b in pairs:
            low[a] = low[b] = min(low[a], low[b])
    assert low == components(list(range(len(prints))), prints)


def test_near_copies_below_the_similarity_are_not_paired(spark):
    """Texts of one size that share 85 % of their shingles are at most 0.74 similar: places in the order tell, no pair is listed."""
    from rollcall.llm.simhash import _meeting_by_rare_shingles

    shared = [f"s{i}" for i in range(170)]
    texts = [shared + [f"t{k}-{i}" for i in range(30)] for k in range(80)]
    frame = spark.createDataFrame([(i, " ".join(t).encode(), 196) for i, t in enumerate(texts)], "node long, text binary, size long")
    assert _meeting_by_rare_shingles(frame.select("node", "size", frame.node.alias("root")), frame, 5, 0.8).collect() == []


def test_groups_equal_brute_force_in_any_order_of_shingles(spark):
    """Short texts, texts of common shingles, sizes that differ: the groups are those of all pairs."""
    from rollcall.llm.simhash import near_copy_groups

    draw = random.Random(13)
    lines = [" ".join(f"w{draw.randrange(400)}" for _ in range(12)) for _ in range(25)]
    texts = [" ".join(draw.choices(lines, k=draw.randint(1, 6))) for _ in range(150)]
    texts += [" ".join(t.split()[: draw.randint(4, 60)]) for t in draw.choices(texts, k=150)]
    base = lines[:5]
    texts += [" ".join(base[:k] + [draw.choice(lines)] + base[k:]) for k in draw.choices(range(6), k=60)] + ["", None, "one"]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if (w := (t or "").split()) else set() for t in texts]
    low = list(range(len(sets)))
    for _ in range(8):
        for i, a in enumerate(sets):
            for j in range(i):
                if 10 * len(a & sets[j]) >= 8 * len(a | sets[j]):
                    low[i] = low[j] = min(low[i], low[j])
    got = {r["row"]: r["root"] for r in near_copy_groups(spark.createDataFrame(list(enumerate(texts)), "row long, text string")).collect()}
    groups = lambda of: sorted(sorted(i for i in range(len(sets)) if of[i] == g) for g in set(of[i] for i in range(len(sets))))
    assert groups(got) == groups(low)


def test_maps_bound_the_difference(spark):
    """Pairs that the maps rule out are below the similarity; texts that share little are ruled out."""
    from rollcall.llm.simhash import _bounded, _sketches

    draw = random.Random(14)
    base = [f"w{draw.randrange(3000)}" for _ in range(400)]
    texts = [" ".join(base[:k] + [f"v{k}-{i}" for i in range(400 - k)]) for k in range(0, 401, 8)]
    frame = _sketches(spark.createDataFrame(list(enumerate(texts)), "row long, text string"), 5).withColumnRenamed("row", "node").cache()
    pairs = [(i, j) for i in range(len(texts)) for j in range(i)]
    left = {(r["hi"], r["lo"]) for r in _bounded(spark.createDataFrame(pairs, "hi long, lo long"), frame, 0.8).collect()}
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in map(str.split, texts)]
    similar = {(i, j) for i, j in pairs if 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j])}
    assert similar and similar <= left and len(left) < 2 * len(similar)


def test_each_link_is_contracted_once(spark, monkeypatch):
    from rollcall.llm import simhash

    rng, given = random.Random(9), []
    contract = simhash.connected_components

    def counted(edges):
        given.append(edges.count())
        return contract(edges)

    monkeypatch.setattr(simhash, "connected_components", counted)
    words = [f"w{i}" for i in range(4000)]
    texts = []
    for group in range(30):
        base = rng.sample(words, 60)
        for copy in range(1 + group % 4):
            changed = list(base)
            changed[copy] = f"c{copy}"
            texts.append(" ".join(changed))
    rows = spark.createDataFrame(list(enumerate(texts)), "row long, text string")
    groups = simhash.near_copy_groups(rows).groupBy("root").count().collect()
    assert len(groups) == 30
    assert sum(given) <= len(texts)


def test_components_joined_by_new_links_equal_those_of_all_links(spark):
    from rollcall.llm.simhash import _joined

    rng = random.Random(4)
    roots, of = spark.createDataFrame([], "id long, root long"), {i: {i} for i in range(60)}
    for _ in range(4):
        links = [tuple(sorted(rng.sample(range(60), 2), reverse=True)) for _ in range(9)]
        for hi, lo in links:
            both = of[hi] | of[lo]
            of.update({i: both for i in both})
        roots = _joined(roots, spark.createDataFrame(links, "hi long, lo long"))
        assert {r["id"]: r["root"] for r in roots.collect()} == {i: min(of[i]) for i in of if min(of[i]) != i}


def test_pairs_of_a_crowd_are_listed_once_and_only_where_maps_allow(spark, monkeypatch):
    """A large group of near copies with 2 to 5 changed words: few pairs are listed, and the groups are those of all pairs."""
    from rollcall.llm import simhash

    draw, listed = random.Random(21), []
    bounded = simhash._bounded

    def counted(pairs, nodes, similarity):
        listed.append(pairs.count())
        return bounded(pairs, nodes, similarity)

    monkeypatch.setattr(simhash, "_bounded", counted)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for copy in range(240):
        changed = list(base)
        for at in draw.sample(range(5, 145), draw.randint(2, 5)):
            changed[at] = f"c{copy}-{at}"
        texts.append(" ".join(changed))
    got = {r["row"]: r["root"] for r in simhash.near_copy_groups(spark.createDataFrame(list(enumerate(texts)), "row long, text string")).collect()}
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in map(str.split, texts)]
    similar = [(i, j) for i in range(len(sets)) for j in range(i) if 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j])]
    low = list(range(len(sets)))
    for _ in sets:
        for i, j in similar:
            low[i] = low[j] = min(low[i], low[j])
    groups = lambda of: sorted(sorted(i for i in range(len(sets)) if of[i] == g) for g in set(of[i] for i in range(len(sets))))
    assert groups(got) == groups(low)
    assert sum(listed) <= 4 * len(texts) + len(similar)


def test_crowds_meet_as_without_maps(spark):
    """Shingles that many sets hold list the pairs that ``_meeting`` lists and maps leave, each in one row."""
    from pyspark.sql import functions as F
    from pyspark.sql.window import Window

    from rollcall.llm.simhash import _bounded, _meeting, _meeting_in_crowds, _sketches, _whole_sets

    draw = random.Random(22)
    lines = [" ".join(f"w{draw.randrange(300)}" for _ in range(15)) for _ in range(12)]
    texts = [" ".join(draw.choices(lines, k=draw.randint(2, 5))) for _ in range(90)]
    rows = spark.createDataFrame(list(enumerate(texts)), "row long, text string")
    nodes = _sketches(rows, 5).withColumnRenamed("row", "node").cache()
    whole = _whole_sets(rows.selectExpr("row as node", "cast(text as binary) as text"), 5).join(nodes.select("node", "size"), "node")
    placed = whole.withColumn("place", F.row_number().over(Window.partitionBy("node").orderBy("h")).cast("long")).where("place <= size - ceil(size * 0.8) + 1").withColumn("root", F.col("node")).cache()
    pairs = lambda met: met.select(F.greatest("node", "other").alias("hi"), F.least("node", "other").alias("lo"))
    left = sorted(map(tuple, _bounded(pairs(_meeting(placed, 0.8)), nodes, 0.8).collect()))
    assert left and sorted(map(tuple, pairs(_meeting_in_crowds(placed, nodes, 0.8)).collect())) == left
