"""Every registered query against its SQL on the smallest driver tables, and the shape of the plans."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as contract
from rollcall.sources.driver_tables import table

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def in_order(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(str(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, database, name):
    frame = contract.queries()[name](spark, FOLDER)
    answer = database.execute(SQL[name])
    expected = in_order([d[0] for d in answer.description], answer.fetchall())
    assert in_order(frame.columns, frame.collect()) == expected
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|PythonUDF|ArrowEvalPython|BatchEvalPython", plan)


def test_entry_gives_companies(spark):
    frame = contract.entry(spark)
    assert frame.count() == 76 and {"id", "phones", "merged_from"} <= set(frame.columns)


@pytest.mark.parametrize("scale, records, clusters, single, largest", [("0.001", 150, 76, 41, 9), ("0.01", 1500, 630, 339, 14)])
def test_known_group_sizes(spark, scale, records, clusters, single, largest):
    folder = f"/root/testdata/sf{scale}"
    members = contract.queries()["company_members"](spark, folder)
    sizes = [r["count"] for r in members.groupBy("id").count().collect()]
    assert (sum(sizes), len(sizes), sizes.count(1), max(sizes)) == (records, clusters, single, largest)


def test_scans_read_only_what_a_query_needs(spark):
    plan = contract.queries()["frequent_page_hosts"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"ReadSchema: (\S+)", plan) == ["struct<url:string>"]
    pushed = contract.queries()["only_new"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderstatus,P)" in pushed
    assert table(spark, FOLDER, "orders").columns[0] == "o_orderkey"


def test_what_is_derived_from_a_small_table_runs_on_all_cores(spark):
    from rollcall.sources import derived_pages, driver_tables

    cores = spark.sparkContext.defaultParallelism
    assert driver_tables.dealt_listings(spark, FOLDER).rdd.getNumPartitions() >= cores
    assert derived_pages.shop_pages(driver_tables.listings(spark, FOLDER)).rdd.getNumPartitions() >= cores
