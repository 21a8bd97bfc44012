import hashlib
import random
import re

import pytest

from rollcall.llm import contamination as module
from rollcall.llm.contamination import contamination, contamination_digest, decontaminated, words_of

DOCS, ITEMS = "doc_id long, text string, pos string, row long, words string", "item_id long, text string, start int"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def audit(docs, items, window=10):
    cut = {}
    for item, text in items:
        w = words(text)
        m = min(len(w), window)
        for s in range(len(w) - m + 1 if w else 0):
            cut.setdefault(tuple(w[s : s + m]), set()).add("" if item is None else str(item))
    found = []
    for doc, text in docs:
        w, hit, ids = words(text), set(), set()
        for m in {len(c) for c in cut}:
            for s in range(len(w) - m + 1):
                if (own := cut.get(tuple(w[s : s + m]))) is not None:
                    hit |= set(range(s, s + m))
                    ids |= own
        found.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(found, key=str)


def marks(spark, docs, items, **options):
    docs = spark.createDataFrame([(*d, "x", 1, "y") for d in docs], DOCS)
    items = spark.createDataFrame([(*i, 0) for i in items], ITEMS)
    return sorted(map(tuple, contamination_digest(docs, items, **options).collect()), key=str)


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(13)
    vocabulary = [f"w{i}" for i in range(50)] + ["ä", "É", "x9"]
    text = lambda k: " ".join(draw.choices(vocabulary, weights=range(1, 54), k=k))
    items = [(i, text(draw.randint(0, 30))) for i in range(40)] + [(None, text(12)), (3, text(12)), (100, text(1)), (101, text(2)), (102, "Only Three words"), (103, None), (104, "- .")]
    docs = []
    for i in range(150):
        parts = text(draw.randint(0, 60)).split(" ")
        if i % 3 == 0:
            other = (draw.choice(items)[1] or "").split(" ")
            low = draw.randrange(len(parts) + 1)
            parts[low:low] = other[draw.randint(0, 3) :]
        docs.append((i if i % 10 else None, draw.choice([" ", ", ", "\n"]).join(parts)))
    docs += [(1, None), (2, ""), (2, ""), (500, " ".join([items[5][1] or "a"] * 900)), (501, (items[7][1] or "").upper())]
    return docs, items


def test_words_by_plain_code(value):
    from pyspark.sql import functions as F

    for text in (None, "", "A-b C3 ÄÖ\x7fd e É", "x_y'z", "abc ABC 12.5"):
        assert value(words_of(F.lit(text).cast("string"))) == words(text)


def test_equals_plain_code(spark, corpus):
    got = marks(spark, *corpus)
    assert got == audit(*corpus)
    assert sum(r[5] for r in got) > 20


@pytest.mark.parametrize("window, bits", [(4, 64), (10, 1 << 10), (25, 1 << 12)])
def test_other_windows_and_full_filters(spark, corpus, window, bits):
    assert marks(spark, *corpus, window=window, bits=bits) == audit(*corpus, window)


def test_common_shingles_and_shared_windows(spark):
    """Every document and many items share words and whole passages: places stay in proportion to the words."""
    passage = "of the and to in is it that for on with as".split()
    docs = [(i, " ".join([*passage, f"u{i}", *passage[:6]] * 3)) for i in range(60)]
    items = [(i, " ".join(passage) + f" q{i}") for i in range(40)] + [(99, "of the and to in is it that for u7")]
    assert marks(spark, docs, items) == audit(docs, items)


def test_prefix_is_the_rarest_shingle(spark):
    docs = [(i, "a b c d e") for i in range(20)] + [(50, "z a b c d e")]
    items = [(1, "z a b c d e")]
    windows = module.item_windows(spark.createDataFrame([(*i, 0) for i in items], ITEMS))
    shingles = module._shingles(windows)
    known = module._filter_bits(shingles, 1 << 10)
    seen = module.seen_shingles(spark.createDataFrame([(*d, "", 0, "") for d in docs], DOCS), known, [3], 1 << 10).where("pos IS NOT NULL")
    assert seen.count() == 20 * 3 + 4
    hits = module.window_hits(seen, shingles).collect()
    assert [(r["start"], r["m"]) for r in hits] == [(0, 6)]


def test_empty_tables(spark, corpus):
    docs, items = corpus
    assert marks(spark, [], items) == []
    assert marks(spark, docs, []) == audit(docs, [])
    assert all(not r[5] for r in marks(spark, docs, [(1, None), (2, "")]))


def test_clean_documents_stay_with_their_columns(spark, corpus):
    docs, items = corpus
    frame = spark.createDataFrame([(*d, "x", 1, "y") for d in docs], DOCS)
    clean = decontaminated(frame, spark.createDataFrame([(*i, 0) for i in items], ITEMS))
    assert clean.columns == frame.columns
    expected = [d for d, m in zip(docs, [audit([d], items)[0] for d in docs]) if not m[5]]
    assert sorted(((r["doc_id"], r["text"]) for r in clean.collect()), key=str) == sorted(expected, key=str)


def test_ids_come_as_lists(spark):
    docs = spark.createDataFrame([(7, "one two", "", 0, "")], DOCS)
    row = contamination(docs, spark.createDataFrame([(10, "two", 0), (9, "one two", 0), (9, "two", 0)], ITEMS)).first()
    assert (row["n_hit"], row["item_ids"]) == (2, ["10", "9"])
