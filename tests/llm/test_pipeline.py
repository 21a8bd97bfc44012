import os

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from rollcall.llm.common import table, to_python
from rollcall.llm.packing import CAPACITIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")


def lowest_of_groups(docs):
    """The smallest id of each group of texts that five-word shingles link at 0.8, by comparing all pairs that share a shingle. Texts without words stand alone or together."""
    words = [(t or "").lower().split() for _, t in docs]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in words]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = {}
    for i, own in enumerate(sets):
        for j in {j for s in own for j in holders.get(s, ())} if own else {j for j in range(i) if not sets[j]}:
            if not own or 10 * len(own & sets[j]) >= 8 * len(own | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
        for s in own:
            holders.setdefault(s, []).append(i)
    lowest = {}
    for i, (doc, _) in enumerate(docs):
        lowest[find(i)] = min(lowest.get(find(i), doc), doc)
    return sorted(lowest.values())


def test_stages_by_plain_code(spark):
    """Every stage against what its operator decides on the rows the stage before has kept."""
    from rollcall.llm.mixing import mix
    from rollcall.llm.toxicity import THRESHOLD, train

    docs = table(spark, FOLDER, "documents")
    score = train(docs, table(spark, FOLDER, "labels")).scorer()
    first = corpus_pipeline.drop_toxic(spark, docs, FOLDER).cache()
    assert first.columns == docs.columns
    assert {r["doc_id"] for r in first.collect()} == {r["doc_id"] for r in docs.collect() if score(r["text"]) < THRESHOLD}
    second = corpus_pipeline.drop_near_copies(spark, first, FOLDER).cache()
    assert second.columns == docs.columns
    assert sorted(r["doc_id"] for r in second.collect()) == lowest_of_groups([(r["doc_id"], r["text"]) for r in first.collect()])
    third = corpus_pipeline.mix_sources(spark, second, FOLDER).cache()
    assert third.columns == docs.columns
    copies = {r["doc_id"]: r["copies"] for r in mix(second).collect() if r["copies"]}
    got = {}
    for r in third.collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
    assert got == copies
    last = corpus_pipeline.pack_sequences(spark, third, FOLDER).collect()
    words = sum(len((r["text"] or "").encode().split()) for r in third.collect())
    assert sum(r["length"] for r in last) == words
    used = {}
    for r in last:
        if r["bin_id"] is not None:
            used[r["bin_id"], r["capacity"]] = used.get((r["bin_id"], r["capacity"]), 0) + r["length"]
    assert all(n <= capacity and capacity in CAPACITIES for (_, capacity), n in used.items())


def test_every_operator_is_registered():
    names = contract.queries()
    assert "pipeline" in names
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert [len(stage) for stage in corpus_pipeline.STAGES] == [2] * 4


def test_documents_with_further_columns(spark):
    """Extra columns of any name, nulls and repeats pass through the stages."""
    docs = table(spark, FOLDER, "documents").limit(60).selectExpr("*", "1 AS score", "'a' AS bits", "2 AS size", "'x' AS `odd.name`", "0 AS row", "'q' AS doc")
    extra = spark.createDataFrame([(None, None, None, None, None, 1, "", 1, "", 0, "")] * 2, docs.schema)
    rows = docs.unionByName(extra).unionByName(docs.limit(3))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, rows, FOLDER)
        assert rows.columns == docs.columns
        rows = spark.createDataFrame(rows.collect(), docs.schema)
    assert corpus_pipeline.pack_sequences(spark, rows, FOLDER).count() >= rows.count() > 0


def test_empty_documents(spark):
    rows = table(spark, FOLDER, "documents").where("1 = 0")
    for _, stage in corpus_pipeline.STAGES:
        rows = stage(spark, rows, FOLDER)
        assert rows.collect() == []


def test_batches_to_python_are_bounded(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    for given, expected in (("64m", "4194304"), ("1m", "1m"), ("128m", "4194304")):
        spark.conf.set(key, given)
        to_python(spark.range(1))
        assert spark.conf.get(key) == expected
    spark.conf.set(key, before)


def test_planted_near_copies_go(spark):
    """Copies with changed words, by brute force over the sets of five-word shingles."""
    import random

    draw = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = []
    for _ in range(60):
        base = draw.choices(vocabulary, k=draw.randint(60, 300))
        texts.append(base)
        for _ in range(3):
            copy = list(base)
            for at in draw.sample(range(len(copy)), draw.randint(1, max(1, len(copy) // 50))):
                copy[at] = draw.choice(vocabulary)
            texts.append(copy)
    hot = draw.choices(vocabulary, k=200)
    for _ in range(80):
        copy = list(hot)
        for at in draw.sample(range(200), 3):
            copy[at] = draw.choice(vocabulary)
        texts.append(copy)
    draw.shuffle(texts)
    expected = lowest_of_groups([(i, " ".join(t)) for i, t in enumerate(texts)])
    docs = spark.createDataFrame([(i, " ".join(t), "en", "s", 0) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()) == expected
    assert len(expected) < len(texts) - 150
