import math
import os

import numpy as np
import pytest

from rollcall.llm.pivots import near_duplicates

SCHEMA = "vec_id long, embedding array<double>, n_links string, n string"


def plain(rows, threshold=0.9):
    ok = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links, root = dict.fromkeys(range(len(rows)), 0), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in ok:
        for b in ok:
            if a < b and len(rows[a][1]) == len(rows[b][1]):
                x, y = (np.array(v) / np.abs(v).max() for v in (rows[a][1], rows[b][1]))
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                    links[a] += 1
                    links[b] += 1
                    root[max(find(a), find(b))] = min(find(a), find(b))
    low = {}
    for i, (name, _) in enumerate(rows):
        low.setdefault(find(i), []).append(name)
    return sorted((n, links[i], min(low[find(i)])) for i, (n, _) in enumerate(rows))


@pytest.fixture(scope="module")
def rows():
    draw = np.random.default_rng(4)
    base = [(i, draw.normal(size=16).tolist()) for i in range(150)]
    near = [(500 - i, (np.array(base[i % 7][1]) + draw.normal(size=16) * 0.12).tolist()) for i in range(120)]
    same = [(600 + i, base[3][1]) for i in range(20)] + [(700 + i, (np.array(base[3][1]) * 2).tolist()) for i in range(3)]
    odd = [(800, None), (801, [0.0] * 16), (802, [float("nan")] * 16), (803, [None] * 16), (804, [1.0, 1.0]), (805, [1.0, 0.9]), (806, []), (807, [1e200, 1e200]), (808, [1e-200, 1e-200])]
    return base + near + same + odd


@pytest.mark.parametrize("block", [512, 8])
def test_links_and_components(spark, rows, block):
    got = near_duplicates(spark.createDataFrame([(i, v, "", "") for i, v in rows], SCHEMA), block=block).collect()
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)
    expected = plain(rows)
    found = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got)
    assert len(found) == len(expected)
    assert sum(n for _, n, _ in found) >= 0.99 * sum(n for _, n, _ in expected)
    assert all(a[1] <= b[1] for a, b in zip(found, expected))
    odd = [r for r in found if 800 <= r[0] < 810]
    assert odd == [r for r in expected if 800 <= r[0] < 810]


def test_recall_at_the_threshold(spark):
    """Pairs at cosines just above the threshold, the hardest ones."""
    draw = np.random.default_rng(9)
    rows = []
    for i in range(600):
        a = draw.normal(size=64)
        b = draw.normal(size=64)
        a /= np.linalg.norm(a)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        rows += [(2 * i, a.tolist()), (2 * i + 1, (0.901 * a + math.sqrt(1 - 0.901**2) * b).tolist())]
    got = near_duplicates(spark.createDataFrame([(i, v, "", "") for i, v in rows], SCHEMA)).collect()
    assert sum(r["n_links"] for r in got) >= 0.9 * 1200


def test_null_ids_repeats_and_empty_table(spark):
    rows = [(1, [1.0, 0.0], "", "")] * 3 + [(None, [1.0, 0.1], "", "")]
    got = sorted((r["vec_id"] or 0, r["n_links"], r["component_id"]) for r in near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [(0, 3, 1), (1, 3, 1), (1, 3, 1), (1, 3, 1)]
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="driver tables are not here")
def test_recall_on_the_driver_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    data = table.toPandas()
    unit = np.stack(data["embedding"].to_numpy()).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    links = sum(int((unit[i : i + 500] @ unit.T >= 0.9).sum()) for i in range(0, len(unit), 500)) - len(unit)
    got = sum(r["n_links"] for r in near_duplicates(table).select("n_links").collect())
    assert 0.9 * links <= got <= links
