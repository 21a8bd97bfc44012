import duckdb
import pytest

from rollcall.llm.licenses import TEMPLATES, license_matches, licenses_sql

SCHEMA = "doc_id long, text string, license string, row string"
NAMES = ("doc_id", "license", "template", "containment", "first_word", "last_word")


def rows(spark):
    filler = " ".join(f"word{i}" for i in range(300))
    out = [(i, f"{filler[: 37 * i]} {text.upper() if i % 2 else text} {filler}") for i, (_, text) in enumerate(TEMPLATES)]
    out += [(100, "Permission is hereby granted, free of charge, to any person"), (101, None), (102, ""), (103, "the MIT License"), (104, filler), (104, filler)]
    cut = TEMPLATES[2][1].split()
    out += [(105, " ".join(cut[:-5])), (106, " ".join(cut[: len(cut) // 2])), (107, (TEMPLATES[0][1] + " ") * 3000)]
    return [(*r, "", "") for r in out]


def found(frame):
    return sorted(tuple(r[n] for n in NAMES) for r in frame.collect())


def test_templates_are_found_wherever_they_stand(spark):
    got = found(license_matches(spark.createDataFrame(rows(spark), SCHEMA)))
    exact = {(r[0], r[2]) for r in got if r[3] == 1}
    assert {(i, i) for i in range(len(TEMPLATES))} <= exact
    by_doc = {r[0] for r in got}
    assert not by_doc & {100, 101, 102, 103, 104, 106} and {105, 107} <= by_doc
    assert next(r[3] for r in got if r[0] == 105) < 1


def test_equals_containment_in_sql(spark, tmp_path):
    frame = spark.createDataFrame(rows(spark), SCHEMA).where("doc_id <> 104")
    frame.coalesce(1).write.parquet(f"{tmp_path}/d")
    database = duckdb.connect()
    database.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    answer = database.execute(licenses_sql())
    assert [d[0] for d in answer.description] == list(NAMES)
    assert sorted(answer.fetchall()) == found(license_matches(frame))


def test_repeated_rows_and_empty_table(spark):
    frame = spark.createDataFrame([(1, TEMPLATES[0][1], "", "")] * 3 + [(None, TEMPLATES[0][1], "", "")], SCHEMA)
    assert [r["doc_id"] for r in license_matches(frame).orderBy("doc_id").collect()] == [None, 1, 1, 1]
    assert license_matches(frame.where("1 = 0")).collect() == []


def test_templates_too_short_or_long(spark):
    frame = spark.createDataFrame([], SCHEMA)
    for text in ("MIT License", "a " * 65):
        with pytest.raises(ValueError):
            license_matches(frame, [("X", text)])
