import math
import random

import pytest

from rollcall.llm import topk
from rollcall.llm.topk import top_k

SCHEMA = "vec_id long, embedding array<double>, score string, rank string"


CONF = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "17"}


def plain(vectors, queries, k):
    ready = lambda rows: {i: [math.floor(256 * x) for x in v] for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    pool, out = ready(vectors), []
    for q, v in ready(queries).items():
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in pool.items() if i != q and len(w) == len(v))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def rows_of(frame):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in frame.collect())


@pytest.fixture(scope="module")
def vectors():
    draw = random.Random(5)
    rows = [(i, [draw.gauss(0, 0.3) for _ in range(8)]) for i in range(300)]
    rows += [(300 + i, list(rows[7][1])) for i in range(40)]  # ties
    rows += [(400, None), (401, [None] * 8), (402, [float("nan")] * 8), (403, [float("inf")] * 8), (404, [0.5, 0.5]), (405, [0.1, 0.9]), (406, []), (None, [0.1] * 8), (407, [0.0] * 8)]
    return rows


@pytest.mark.parametrize("bins, block", [(512, 8192), (4, 50)])
def test_equals_brute_force(spark, vectors, bins, block, monkeypatch):
    # Each cell in a task of its own, as on large tables.
    before = {k: spark.conf.get(k) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    monkeypatch.setattr(topk, "VECTOR_BLOCK", block)
    monkeypatch.setattr(topk, "QUERY_BLOCK", block // 4)
    frame = spark.createDataFrame([(i, v, "", "") for i, v in vectors], SCHEMA)
    asked = [r for r in vectors if r[0] is not None and r[0] % 7 == 0 or r[0] in (404, 406)]
    queries = spark.createDataFrame([(i, v, "", "") for i, v in asked], SCHEMA)
    for k in (1, 5, 400):
        assert rows_of(top_k(frame, queries, k=k, bins=bins)) == plain(vectors, asked, k)
    for k, v in before.items():
        spark.conf.set(k, v)


def test_large_components(spark):
    rows = [(1, [1e8, 1.0]), (2, [1e8, -1.0]), (3, [1e5, 3.0]), (4, [-1e8, 0.5]), (5, [-1e300, 0.5])]
    frame = spark.createDataFrame([(i, v, "", "") for i, v in rows], SCHEMA)
    got = rows_of(top_k(frame, frame.where("vec_id = 3"), k=4))
    assert [(q, r, i) for q, r, i, _ in got] == [(3, 1, 1), (3, 2, 2), (3, 3, 4), (3, 4, 5)]
    assert got[0][3] - got[1][3] == 2 * 256 * 768


def test_repeated_rows_and_empty_table(spark):
    frame = spark.createDataFrame([(1, [0.5], "", ""), (1, [0.5], "", ""), (2, [0.25], "", "")], SCHEMA)
    assert rows_of(top_k(frame, frame)) == [(1, 1, 2, 8192), (2, 1, 1, 8192)]
    none = frame.where("1 = 0")
    assert top_k(none, none).collect() == [] and top_k(none, frame).collect() == []
