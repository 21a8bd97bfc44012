import random
from collections import Counter

import pytest

from rollcall.llm.packing import _fill, bin_cost, pack, plan_bins, sequences

SCHEMA = "doc_id long, text string, length string, bin_id string"


def one_by_one(lengths, capacities, stretch):
    """Best fit, item by item: what is used of each bin, with its capacity."""
    bins = []
    for length in sorted(lengths, reverse=True):
        fitting = [b for b in bins if b[1] - b[0] >= length]
        if fitting:
            min(fitting, key=lambda b: b[1] - b[0])[0] += length
        else:
            bins.append([length, next((c for c in capacities if c >= length * stretch), capacities[-1])])
    return Counter(map(tuple, bins))


@pytest.mark.parametrize("seed", range(6))
def test_histogram_plan_equals_item_by_item(seed):
    draw = random.Random(seed)
    lengths = [min(64, int(draw.paretovariate(0.6))) for _ in range(400)]
    capacities = (8, 16, 32, 64)
    for stretch in (1, 2, 8):
        groups = _fill(sorted(Counter(lengths).items(), reverse=True), capacities, stretch)
        used = Counter()
        for g in groups:
            used[g.used] += g.count
            assert g.used == sum(k * n for k, n in g.contents)
        expected = Counter()
        for (filled, _), n in one_by_one(lengths, capacities, stretch).items():
            expected[filled] += n
        assert used == expected


def test_cost_is_the_least_of_the_rules():
    draw = random.Random(7)
    lengths = [draw.randint(1, 64) for _ in range(500)]
    capacities, overhead = (8, 16, 32, 64), 3
    costs = []
    for k in range(8):
        bins = one_by_one(lengths, capacities, 2**k)
        costs.append(sum(bin_cost(next(c for c in capacities if c >= used), overhead, 100) * n for (used, _), n in bins.items()))
    assert plan_bins(Counter(lengths), capacities, overhead, 100).cost == pytest.approx(min(costs))


def test_every_piece_has_its_place(spark):
    draw = random.Random(3)
    rows = [(i, "w " * draw.choice([0, 1, 5, 9, 30, 64, 65, 200]), "x", "y") for i in range(500)]
    rows += [(None, "a b c", "", ""), (3, "a b c", "", ""), (3, "a b c", "", ""), (9000, None, "", ""), (9001, "", "", "")]
    placed = pack(spark.createDataFrame(rows, SCHEMA), capacities=(16, 32, 64), overhead=2)
    found = placed.collect()
    words = Counter()
    bins = {}
    for r in found:
        words[r["doc_id"]] += r["length"]
        assert r["start"] == r["piece"] * 64
        if r["length"]:
            bins.setdefault((r["bin_id"], r["capacity"]), []).append((r["offset"], r["length"]))
        else:
            assert r["bin_id"] is None
    expected = Counter()
    for i, text, *_ in rows:
        expected[i] += len((text or "").split())
    assert +words == +expected and set(words) == set(expected)
    assert len({b for b, _ in bins}) == len(bins)
    for (_, capacity), items in bins.items():
        items.sort()
        at = 0
        for offset, length in items:
            assert offset == at
            at += length
        assert at <= capacity and not any(at <= c < capacity for c in (16, 32, 64))
    lines = sequences(placed).collect()
    assert len(lines) == len(bins) and all(r["used"] == sum(s["length"] for s in r["spans"]) for r in lines)


def test_one_common_length_and_empty_table(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "'a b c' AS text", "'' AS length", "'' AS bin_id")
    rows = pack(docs, capacities=(16, 32), overhead=4, attention=1000).collect()
    places = {(r["bin_id"], r["offset"]) for r in rows}
    assert len(places) == 3000 and len({r["bin_id"] for r in rows}) in (300, 600)
    assert pack(docs.where("1 = 0")).collect() == []
