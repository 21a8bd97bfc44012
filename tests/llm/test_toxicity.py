import random
import zlib

import pytest

from rollcall.llm.toxicity import SWAPS, counterfactuals, held_out, toxicity, train, without_toxic

DOCS = "doc_id long, text string, score string, held_out string"
WORDS = "river stone garden window morning paper small green walk letter road music house winter table".split()


def corpus(n=600, seed=1):
    """Insults make a text toxic. In training texts insults often come with one group's name, which is neutral by itself."""
    draw = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = draw.choices(WORDS, k=30)
        toxic = i % 3 == 0
        if toxic:
            words[5] = draw.choice(["vilething", "vilehead", "vilish"])
        if draw.random() < (0.9 if toxic else 0.1):
            words[20:22] = ["muslims", "are"]
        docs.append((i, " ".join(words) + ".", "x", "y"))
        labels.append((i, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = corpus()
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id long, toxic int"), dict(labels)


def test_held_out_accuracy(tables):
    docs, labels, truth = tables
    rows = toxicity(docs, labels).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    apart = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in apart) / len(apart) > 0.97


def test_swaps_take_the_weight_off_neutral_names(tables):
    docs, labels, _ = tables
    text = "river stone garden window morning muslims are small green walk."
    plain, fair = train(docs, labels, swap_weight=0.0), train(docs, labels)
    assert fair.scorer()(text) < plain.scorer()(text)
    other = text.replace("muslims", "christians")
    assert abs(fair.scorer()(text) - fair.scorer()(other)) < 0.5 * abs(plain.scorer()(text) - plain.scorer()(other))
    assert fair.scorer()(text) < 0.3


def test_labels_of_held_out_rows_teach_nothing(spark, tables):
    docs, labels, _ = tables
    changed = labels.select("doc_id", (labels.toxic * (~held_out("doc_id")).cast("int")).cast("int").alias("toxic"))
    assert train(docs, labels).weights == train(docs, changed).weights


def test_counterfactuals():
    pairs = set(counterfactuals("I met some jews. Nothing here!"))
    assert len(pairs) == len(SWAPS["jews"])
    assert all("jews" in lost and "jews" not in gained for lost, gained in pairs)
    assert list(counterfactuals("river stone")) == []


def test_odd_rows(spark, tables):
    docs, labels, _ = tables
    odd = spark.createDataFrame([(None, "vilething", "", ""), (9001, None, "", ""), (9002, "", "", ""), (9003, "x " * 200_000, "", ""), (9003, "x", "", "")], DOCS)
    rows = toxicity(docs.unionByName(odd), labels.union(spark.createDataFrame([(9001, None), (None, 1), (77777, 1), (0, 1)], "doc_id long, toxic int"))).collect()
    assert len(rows) == 605
    scores = {r["doc_id"]: r["score"] for r in rows}
    assert scores[9001] == scores[9002]


def test_without_labels(spark, tables):
    docs, labels, _ = tables
    for few in (labels.where("1 = 0"), labels.where("toxic = 0")):
        assert {r["predicted"] for r in toxicity(docs, few).collect()} <= {0, 1}
    assert toxicity(docs.where("1 = 0"), labels).collect() == []


def test_toxic_rows_go(tables):
    docs, labels, truth = tables
    kept = without_toxic(docs, labels)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert sum(truth[i] for i in ids) < 5 and sum(1 - truth[i] for i in ids) > 390
