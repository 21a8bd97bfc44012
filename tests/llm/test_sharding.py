import duckdb

from rollcall.llm.sharding import sharding_sql, shards, write_shards

SCHEMA = "doc_id long, text string, shard string"


def docs(spark):
    rows = [(i, "x" * (i * 37 % 400), "clash") for i in range(2000)] + [(None, "null", ""), (5000, None, None), (5001, "", "")]
    return spark.createDataFrame(rows, SCHEMA)


def test_every_shard_fits_and_none_splits_without_need(spark):
    rows = shards(docs(spark), 10_000).collect()
    assert len(rows) == 2003
    sums = {}
    for r in rows:
        sums[r["shard"]] = sums.get(r["shard"], 0) + r["bytes"]
        assert len(r["shard"]) == r["depth"]
    assert all(r["shard_bytes"] == sums[r["shard"]] <= 10_000 for r in rows)
    # No shard is the prefix of another, and what two buckets split from was too large.
    names = sorted(sums)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:]))
    for name in names:
        assert sum(v for k, v in sums.items() if k.startswith(name[:-1])) > 10_000


def test_equals_its_sql(spark, tmp_path):
    frame = docs(spark)
    frame.coalesce(1).write.parquet(f"{tmp_path}/d")
    database = duckdb.connect()
    database.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    answer = database.execute(sharding_sql(10_000))
    names = [d[0] for d in answer.description]
    assert sorted(map(str, answer.fetchall())) == sorted(str(tuple(r)) for r in shards(frame, 10_000).select(*names).collect())


def test_long_rows_and_one_key(spark):
    rows = [(1, "y" * 100, "a")] * 300 + [(2, "z" * 5000, "a"), (3, "q" * 10, "a")]
    frame = spark.createDataFrame(rows, SCHEMA)
    found = shards(frame, 1000).collect()
    assert len(found) == 302
    large = [r for r in found if r["bytes"] > 1000]
    assert len(large) == 1 and large[0]["shard"].startswith("+") and large[0]["shard_docs"] == 1
    assert all(r["shard_bytes"] <= 1000 for r in found if r["bytes"] <= 1000)
    assert max(r["depth"] for r in found if r["bytes"] == 100) > 32


def test_empty_table(spark):
    assert shards(spark.createDataFrame([], SCHEMA)).collect() == []


def test_written_shards(spark, tmp_path):
    frame = docs(spark).where("doc_id < 300")
    write_shards(frame, f"{tmp_path}/out", 10_000)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 300


def test_written_shards_of_one_key_fit(spark, tmp_path):
    """Rows of one id and of null ids lie in the folders of the shards they were given."""
    rows = [(7, "x" * 100, str(i)) for i in range(300)] + [(None, "y" * 90, str(i)) for i in range(200)] + [(i, "z" * 50, "") for i in range(100, 200)]
    write_shards(spark.createDataFrame(rows, SCHEMA), f"{tmp_path}/out", 1000)
    back = [(r["in_shard"], r) for r in spark.read.option("spark.sql.sources.partitionColumnTypeInference.enabled", "false").parquet(f"{tmp_path}/out").collect()]
    sums = {}
    for name, r in back:
        sums[name] = sums.get(name, 0) + len(r["text"])
    assert sorted(map(str, ((r["doc_id"], r["text"], r["shard"]) for _, r in back))) == sorted(map(str, rows))
    assert max(sums.values()) <= 1000 and len(sums) > 48
