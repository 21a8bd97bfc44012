from collections import Counter

import duckdb
import pytest

from rollcall.llm.mixing import mix, mixed_rows, mixing_sql

SCHEMA = "doc_id long, text string, source string, size string"


def targets(sizes, weights=(5, 2, 1), cap=3):
    """Targets by the rule in words: share by weight, cap, share the excess again."""
    names = sorted((n for n in sizes if n is not None)) + [n for n in sizes if n is None]
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [n for n in names if n not in fixed]
        left = total - sum(fixed.values())
        got = {n: left * weight[n] / sum(weight[m] for m in free) for n in free}
        above = [n for n in free if got[n] > cap * sizes[n]]
        if not above:
            return fixed | got
        fixed |= {n: cap * sizes[n] for n in above}


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, "w " * (1 + i * 7 % 90), f"s{min(i % 9, 4)}", "x") for i in range(900)]
    rows += [(1000 + i, "a b\tc", None, None) for i in range(5)] + [(None, "null id", "s1", "x"), (2000, None, "s2", ""), (2001, "", "s3", "")]
    return spark.createDataFrame(rows, SCHEMA)


def test_targets_and_sizes(corpus):
    rows = mix(corpus).collect()
    assert len(rows) == corpus.count()
    sizes = {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    expected = targets(sizes)
    for name, size in sizes.items():
        own = [r for r in rows if r["source"] == name]
        assert {r["source_size"] for r in own} == {size}
        assert own[0]["target"] == pytest.approx(expected[name])
        assert sum(r["taken"] for r in own) == pytest.approx(expected[name], abs=45)
    assert all(r["taken"] == r["copies"] * r["size"] <= 3 * r["size"] for r in rows)


def test_reruns_agree_and_seeds_differ(corpus):
    taken = lambda **o: sorted((r["doc_id"] or -1, r["taken"]) for r in mix(corpus, **o).collect())
    assert taken() == taken() != taken(seed="other")


def test_inclusion_follows_the_ratio(spark):
    """Over many seeds a document is taken about as often as its source's ratio says."""
    docs = spark.createDataFrame([(i, "w " * 10, "ab"[i % 2], "") for i in range(40)], SCHEMA)
    seen = [sum(r["copies"] for r in mix(docs, seed=str(s)).collect() if r["source"] == "b") for s in range(3)]
    assert all(s == pytest.approx(20 * (2 / 7 * 400 / 200), abs=1) for s in seen)


@pytest.mark.parametrize("long", [0, 3])
def test_equals_its_sql(spark, corpus, tmp_path, long):
    """Also where documents of many words end the sample of a source."""
    more = spark.createDataFrame([(5000 + i, "w " * (9000 - 700 * i), f"s{i}", "") for i in range(long)], SCHEMA)
    unique = corpus.where("doc_id IS NOT NULL").unionByName(more)
    unique.coalesce(1).write.parquet(f"{tmp_path}/d")
    database = duckdb.connect()
    database.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    answer = database.execute(mixing_sql())
    names = [d[0] for d in answer.description]
    expected = sorted(map(str, answer.fetchall()))
    assert sorted(str(tuple(r)) for r in mix(unique).select(*names).collect()) == expected


def test_rows_keep_their_columns_and_copies(spark, corpus):
    more = spark.createDataFrame([(5000 + i, "w " * (9000 - 700 * i), f"s{i}", "") for i in range(3)] + [(None, "null id", "s1", "y")] * 7, SCHEMA)
    for docs in (corpus, corpus.unionByName(more)):
        decided = Counter()
        for r in mix(docs).collect():
            decided[r["doc_id"], r["source"], r["size"]] += r["copies"]
        rows = mixed_rows(docs)
        assert rows.columns == docs.columns
        assert Counter((r["doc_id"], r["source"], len((r["text"] or "").split())) for r in rows.collect()) == +decided


def test_texts_are_not_dealt(spark, tmp_path):
    """Copies are decided where the text lies."""
    spark.range(3000).selectExpr("id AS doc_id", "repeat('w ', 20) AS text", "concat('s', id % 5) AS source", "'' AS size").write.parquet(f"{tmp_path}/d")
    rows = mixed_rows(spark.read.parquet(f"{tmp_path}/d"))
    assert rows.count() > 0
    shuffled = [line for line in rows._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]
    assert sum("hashpartitioning(id#" not in line for line in shuffled) <= 1  # the few rows of ids across the end


def test_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "a b c d", "s", "")] * 10 + [(2, "e f g h", "t", "")] * 2, SCHEMA)
    rows = mix(docs).collect()
    assert len(rows) == 12
    assert len(mixed_rows(docs).collect()) == sum(r["copies"] for r in rows)


def test_empty_table(spark):
    assert mix(spark.createDataFrame([], SCHEMA)).collect() == []
    assert mixed_rows(spark.createDataFrame([], SCHEMA)).collect() == []


def test_a_very_long_document_does_not_end_the_sample(spark):
    """One document holds a third of the words of its source; the short ones after it fill the target."""
    rows = [(i, "w " * 20, "a", "") for i in range(400)] + [(1000 + i, "w " * 20, "b", "") for i in range(400)] + [(2000, "w " * 4000, "b", "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    for seed in ("", "1", "2", "3", "4", "5"):
        got = [r for r in mix(docs, seed=seed).collect() if r["source"] == "b"]
        assert sum(r["taken"] for r in got) == pytest.approx(got[0]["target"], rel=0.01)
