import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from rollcall.llm import collocations as module
from rollcall.llm.collocations import WordIndex, collocations, longer_phrases, phrase_report, tokens

SCHEMA = "doc_id long, text string, lang string, n long, word string, shard long"


def pieces(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", lowered)]


def report(rows, min_count, top=2000, longest=4):
    """All phrases counted in dictionaries."""
    counts = defaultdict(Counter)
    for text, lang in rows:
        for words in pieces(text):
            for size in range(1, longest + 1):
                counts["und" if lang is None else lang].update(tuple(words[s : s + size]) for s in range(len(words) - size + 1))
    found = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: c for p, c in f.items() if len(p) > 1 and c >= min_count}
        kept = []
        for p, a in candidates.items():
            if any(100 * c >= 80 * a and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))) for q, c in candidates.items()):
                continue
            score, _, left, right = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        found += [(lang, k, phrase.decode(), -a, left, right, n, -score) for k, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1)]
    return sorted(found)


def rows_of(spark, rows, **options):
    frame = spark.createDataFrame([(i, *r, 0, "w", 1) for i, r in enumerate(rows)], SCHEMA)
    return sorted(map(tuple, phrase_report(frame, **options).collect()))


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(12)
    words = ["the", "of", "New", "york", "city", "é", "x\x00y", "a-b", "zu zu", "\x7f"] + [f"w{i}" for i in range(12)]
    rows = []
    for _ in range(250):
        text = ""
        for _ in range(draw.randint(0, 25)):
            text += draw.choice([*words, "new york city hall", "the of the of", "rare%d" % draw.randrange(10**6)]) + draw.choice([" ", " ", "  ", "\t", ", ", ".\n", "; "])
        rows.append((text, draw.choice(["en", "en", "en", "de", None, "und", ""])))
    return rows + [(None, "en"), ("", "fr"), (" \t.,", "fr"), ("the of " * 4000, "en"), ("one two", "it")] + [("same same same", "es")] * 9


def test_tokens_by_plain_code():
    for text in (None, "", "A b,c\td..E!\r\nf  g", "Ä\x85 x\x00y"):
        got = [t for t in re.split(rb"\n", b" ".join(tokens(None if text is None else text.encode())))]
        assert [[w.decode() for w in p.split(b" ") if w] for p in got] == pieces(text)


@pytest.mark.parametrize("min_count, shard_words", [(30, 4_000_000), (5, 200), (2, 1), (9, 3000)])
def test_equals_plain_code(spark, corpus, min_count, shard_words):
    assert rows_of(spark, corpus, min_count=min_count, shard_words=shard_words) == report(corpus, min_count)


def test_shorter_phrases_and_the_first_of_them(spark, corpus):
    assert rows_of(spark, corpus, min_count=5, longest=3, top=7) == report(corpus, 5, top=7, longest=3)
    assert rows_of(spark, corpus, min_count=5, longest=2) == report(corpus, 5, longest=2)


def test_extensions_are_the_best_to_either_side(spark):
    rows = [("a b c", "en")] * 5 + [("a b d", "en")] * 4 + [("x a b", "en")] * 7
    got = {r["phrase"]: (r["a"], r["left"], r["right"]) for r in collocations(spark.createDataFrame([(i, *r, 0, "", 0) for i, r in enumerate(rows)], SCHEMA), min_count=4).collect()}
    assert got["a b"] == (16, 7, 5)


def test_empty_table(spark):
    assert rows_of(spark, []) == []
    assert rows_of(spark, [(None, "en"), ("a b", None)]) == []


def test_intervals_count_and_extend_to_both_sides():
    draw = random.Random(3)
    for _ in range(30):
        symbols = np.array([draw.choice([0, 1, 2, 2, 3]) for _ in range(draw.randint(1, 60))])
        index = WordIndex.of(symbols, np.array([5, 9, 12]))
        count = Counter()
        for part in "".join("afjm"[i] for i in symbols).split("a"):
            for size in range(1, 5):
                count.update(part[s : s + size] for s in range(len(part) - size + 1))
        first, low, back, n = index.words()
        texts = [chr(97 + i) for i in first]
        for turn in range(4):
            assert {t: c for t, c in zip(texts, n.tolist()) if c} == {p: c for p, c in count.items() if len(p) == turn + 1}
            again = index.find([np.array([ord(t[i]) - 97 for t in texts], np.int64) for i in range(turn + 1)])
            assert [a.tolist() for a in again] == [low.tolist(), back.tolist(), n.tolist()]
            if turn < 3:
                of, word, low, back, n = (index.left if turn % 2 else index.right)(low, back, n)
                texts = [chr(97 + w) + texts[o] if turn % 2 else texts[o] + chr(97 + w) for o, w in zip(of, word)]


def test_shards_are_not_dealt_twice(spark):
    phrases = spark.createDataFrame([(1, 0, 0, 0)], "shard long, k1 long, k2 long, n long")
    plan = longer_phrases(phrases, 2, "", 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Exchange rangepartitioning(shard" in plan


def test_a_phrase_is_one_row_of_a_group_of_shards(spark, corpus, monkeypatch):
    """Many small shards: rows are those of few groups, and the report is the same, also where a shard lacks words of its group."""
    made, frequent, built, build = [], module._frequent, [], module.build_indexes

    def counted(phrases, min_count):
        made.append([tuple(r) for r in phrases.select("shard", "k1", "k2", "n").collect()])
        return frequent(phrases, min_count)

    def noted(*given):
        built.append(given[4])
        return build(*given)

    monkeypatch.setattr(module, "_frequent", counted)
    monkeypatch.setattr(module, "build_indexes", noted)
    assert rows_of(spark, corpus, min_count=5, shard_words=30) == report(corpus, 5)
    for rows in made:
        assert len({r[:3] for r in rows}) == len(rows) and all(r[3] > 0 for r in rows)
        assert 8 < len({r[0] for r in rows}) <= built[0] / 2


def test_a_word_that_a_shard_lacks_is_not_found():
    index = WordIndex.of(np.array([1, 2, 0, 1, 2]), np.array([5, 9]))
    assert index.find([np.array([5, 5, 4, 9, 99]), np.array([9, 7, 9, 99, 99])])[2].tolist() == [2, 0, 0, 0, 0]
