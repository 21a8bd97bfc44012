import re
from collections import Counter, defaultdict

import pytest

from rollcall.llm import divergence
from rollcall.llm.divergence import source_divergence, terms

SCHEMA = "doc_id long, text string, lang string, source string, term string, idx long"


def plain_terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def audit(rows, min_docs, top=10):
    """All kept terms of all pairs, with Python integers."""
    docs = [(lang or "", source or "", Counter(plain_terms(text))) for text, lang, source in rows]
    found = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        spread = Counter(t for d in own for t in d[2])
        kept = [t for t, n in spread.items() if n >= min_docs]
        counts = defaultdict(Counter)
        for _, source, terms_ in own:
            counts[source].update({t: n for t, n in terms_.items() if t in set(kept)})
        whole = sum(counts.values(), Counter())
        share = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept}
        f = lambda p, q: (p - q) ** 2 // (p + q)
        p, q = {s: share(c) for s, c in counts.items()}, share(whole)
        for s in counts:
            parts = {
                "pair": [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in counts if o != s],
                "term": [(t, f(p[s][t], q[t])) for t in kept if counts[s][t] and p[s][t] > q[t]],
            }
            for part, values in parts.items():
                ranked = sorted(values, key=lambda x: (-x[1], x[0].encode()))
                found += [(lang, s, part, item, value, k) for k, (item, value) in enumerate(ranked, 1) if part == "pair" or k <= top]
    return sorted(found)


def rows_of(spark, rows, **options):
    frame = spark.createDataFrame([(i, *r, "x", 0) for i, r in enumerate(rows)], SCHEMA)
    return sorted(map(tuple, source_divergence(frame, **options).collect()))


@pytest.fixture(scope="module")
def corpus():
    import random

    draw = random.Random(11)
    words = [f"{a}{b}" for a in "abcdefg" for b in ("é", "x", "Y", "zu", "'s", "1")]
    rows = []
    for i in range(160):
        source = draw.choice(["s1"] * 6 + [f"s{k}" for k in range(9)] + [None, ""])
        rows.append((" ".join(draw.choices(words, weights=range(1, len(words) + 1), k=draw.randint(0, 40))), draw.choice(["en", "en", "de", None]), source))
    rows += [(None, "en", "s1"), ("", "fr", "only"), ("\t?! 12", "fr", "other"), ("One two", "it", "lonely")] + [("same Text", "es", "t")] * 4 + [("same words " * 3000, "es", "u")]
    return rows


def test_terms_by_plain_code():
    for text in (None, "", "Abc-DEF 1x2 ÄÖ ä\x7fb c\x85d", "a_b`c{d}e@f[g]", "é" * 5):
        assert terms(None if text is None else text.encode()) == [t.encode() for t in plain_terms(text)]


@pytest.mark.parametrize("min_docs", [1, 3, 10])
def test_equals_plain_code(spark, corpus, min_docs):
    assert rows_of(spark, corpus, min_docs=min_docs) == audit(corpus, min_docs)


def test_blocks_and_small_buffers_change_nothing(spark, corpus, monkeypatch):
    expected = audit(corpus, 3, top=4)
    monkeypatch.setattr(divergence, "BLOCK", 2)
    monkeypatch.setattr(divergence, "ENTRIES", 5)
    monkeypatch.setattr(divergence, "COMBINATIONS", 3)
    monkeypatch.setattr(divergence, "PAIRS", 1)
    assert rows_of(spark, corpus, min_docs=3, top=4) == expected


def test_a_source_with_most_rows(spark):
    rows = [(f"a b c{i % 7} d{i % 3}", "en", "hot" if i % 3 else f"s{i % 5}") for i in range(400)]
    assert rows_of(spark, rows) == audit(rows, 10)


def test_empty_table_and_no_kept_terms(spark):
    assert rows_of(spark, []) == []
    rows = [("a", "en", "x"), ("b", "en", "y"), (None, "en", "z")]
    got = rows_of(spark, rows)
    assert got == audit(rows, 10)
    assert {r[4] for r in got} == {0} and len(got) == 6


def test_a_node_is_corrected_once_for_all_terms_below():
    path = divergence._Path()
    for items, m in [([(0, 5, 1), (1, 7, 2)], 4), ([(0, 5, 1), (1, 7, 2), (2, 9, 3)], 2), ([(0, 6, 1), (2, 9, 3)], 1)]:
        path.insert(items, m, 0)
    path.leave(0, 0)
    assert len(path.found[0]) == 4  # (0, 1) once for six terms, (0, 2) and (1, 2) for two, (0, 2) below the other share
    path.correct()
    f = lambda x, y: (x - y) ** 2 // (x + y)
    c = lambda p, b, q, d: f(p, q) - f(p, d) - f(b, q) + f(b, d)
    assert path.sums == {(0, 1): 6 * c(5, 1, 7, 2), (0, 2): 2 * c(5, 1, 9, 3) + c(6, 1, 9, 3), (1, 2): 2 * c(7, 2, 9, 3)}
