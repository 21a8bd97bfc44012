import glob
import os

from pyspark.sql import functions as F

from rollcall.operators.merge import resolve_entities
from rollcall.sinks.reports import conflict_lines, conflicts_report, export_all, read_csv, write_csv
from rollcall.scratch import keep, scratch_dropped_after, scratch_path
from rollcall.sinks.tables import ScopedTable, Snapshots, append_listings, read_scope, upsert
from rollcall.streaming.ingest import ingest, listing_stream, new_listings, of_same_scopes
from tests.test_companies import company, table
from tests.test_grouping import listing
from tests.test_grouping import table as listing_table


def files(path):
    return sorted(glob.glob(f"{path}/city=*/part-*"))


def scored(spark):
    return table(
        spark,
        company(1, "Один", ["a", "b"], "s.ru", ["x@y"], "Тверь", {"telegram": "https://t.me/a_(b)"}, score=30, segment="B"),
        company(2, "Два|[x]", [], None, [], "Тверь", {}, score=80, segment="A", network=True),
        company(3, "Три", [], None, [], "Тверь", {}, score=50, segment="A"),
        company(4, "Там", [], None, [], "Орёл", {}, score=None, segment="?"),
    )


def test_csv(spark, tmp_path):
    write_csv(scored(spark).coalesce(1), str(tmp_path / "csv"))
    texts = [open(f, encoding="utf-8").read() for f in files(tmp_path / "csv") if "city=Тверь" in f]
    lines = [line for text in texts for line in text.splitlines()]
    assert texts[0].startswith("﻿id,name,phones,address,website,emails,segment,crm_score,is_network,cms,has_marquiz,telegram,vk,whatsapp")
    data = [line for line in lines if not line.startswith("﻿")]
    assert [line.split(",")[0] for line in data] == ["2", "3", "1"]
    assert data[2] == '1,Один,a; b,"",s.ru,x@y,B,30,No,unknown,No,https://t.me/a_(b),"",""'
    assert data[0].split(",")[8] == "Yes"


def test_exports(spark, tmp_path):
    presets = {
        "md": {"description": "Описание", "filters": "1=1", "format": "markdown"},
        "js": {"filters": "telegram IS NOT NULL", "format": "json"},
        "broken": {"filters": "crm_score >=", "format": "csv"},
        "plain": {"filters": "crm_score >= 50", "format": "csv"},
    }
    done = export_all(scored(spark), str(tmp_path), presets)
    assert done["broken"].startswith("error") and set(done) == {"enriched", *presets}
    lines = [line for f in files(done["md"]) if "city=Тверь" in f for line in open(f, encoding="utf-8").read().split("\n")[:-1]]
    assert lines == [
        "# База мастерских: Тверь — md",
        "",
        "**Фильтр:** Описание",
        "",
        "**Всего компаний:** 3",
        "",
        "## Сегмент A (2 шт.)",
        "",
        "| Название | Телефон | Сайт | Telegram | CMS | Score |",
        "|----------|---------|------|----------|-----|-------|",
        r"| **Два\|\[x\]** |  | - | - | unknown | 80 |",
        "| **Три** |  | - | - | unknown | 50 |",
        "",
        "## Сегмент B (1 шт.)",
        "",
        "| Название | Телефон | Сайт | Telegram | CMS | Score |",
        "|----------|---------|------|----------|-----|-------|",
        r"| **Один** | a<br>b | [Сайт](s.ru) | [TG](https://t.me/a_\(b\)) | unknown | 30 |",
        "",
    ]
    assert [r.id for r in spark.read.json(done["js"]).collect()] == [1]
    assert spark.read.csv(done["plain"], header=True).count() == 2
    literal = export_all(scored(spark), str(tmp_path / "lit"), {"js": presets["js"]}, literal=True)
    assert spark.read.csv(literal["js"], header=True).count() == 1


def test_conflict_report(spark, tmp_path):
    rows = [
        listing(1, "Один", ["89031234567"], "s.ru", [], "г. Тверь, ул. Ленина, 1", city="Тверь"),
        listing(2, "Два", ["89031234567"], None, [], "г. Тверь, ул. Маркса, 2", city="Тверь"),
        listing(3, "Три", [], None, [], "г. Тверь, ул. Маркса, 2", city="Тверь"),
    ]
    resolved = resolve_entities(listing_table(spark, rows))
    lines = conflict_lines(resolved.labelled, resolved.companies).orderBy("number", "variant", "pos")
    text = [r.line for r in lines.collect()]
    assert text[:3] == ["# Конфликты дедупликации — Тверь", "", "**Найдено конфликтов:** 1"]
    assert "## 1. Конфликт #1" in text and "**Причина:** same_name_diff_address" in text
    assert "- [ ] **Вариант A:** Один" in text and "- [ ] **Вариант B:** Два" in text
    assert "  Сайт: s.ru" in text and "  Сайт: N/A" in text and "  Телефон: 79031234567" in text and "  ID: 2" in text
    conflicts_report(resolved.labelled, resolved.companies, str(tmp_path / "c"))
    written = [line for f in files(tmp_path / "c") for line in open(f, encoding="utf-8").read().split("\n")[:-1]]
    assert written == text


def test_upsert_and_snapshots(spark, tmp_path):
    old = spark.createDataFrame([(1, "T", "a"), (2, "U", "b")], "id long, city string, v string")
    new = spark.createDataFrame([(2, "U", None), (3, "T", "c")], "id long, city string, v string")
    assert {(r.id, r.v) for r in upsert(old, new).collect()} == {(1, "a"), (2, "b"), (3, "c")}
    wider = spark.createDataFrame([(2, "U", "tilda"), (4, "T", None)], "id long, city string, cms string")
    assert {tuple(r) for r in upsert(old, wider).collect()} == {(1, "T", "a", None), (2, "U", "b", "tilda"), (4, "T", None, None)}
    store = Snapshots(spark, str(tmp_path / "snap"))
    assert store.read() is None and store.delete_scopes(["T"]) is None
    store.upsert(old)
    store.upsert(new)
    assert store.version() == 2 and store.read().count() == 3
    assert {r.id for r in store.delete_scopes(["T"]).collect()} == {2}
    assert spark.read.parquet(str(tmp_path / "snap/v1")).count() == 2


def test_append_and_scope_read(spark, tmp_path):
    path = str(tmp_path / "raw")
    rows = listing_table(spark, [listing(1, city="T"), listing(2, city="U")])
    append_listings(rows, path)
    append_listings(rows, path)
    one = read_scope(spark, path, "T")
    assert one.count() == 2 and read_scope(spark, path).count() == 4
    assert "PartitionFilters: [isnotnull(city" in one._jdf.queryExecution().toString()


def test_stream_takes_each_address_once(spark, tmp_path):
    source, target, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    first = listing_table(spark, [listing(1), listing(2), listing(3)]).withColumns(
        {"source_url": F.when(F.col("id") < 3, "https://u/1").otherwise(""), "scraped_at": F.timestamp_seconds(F.lit(1_700_000_000))}
    )
    first.coalesce(1).write.parquet(source)
    ingest(listing_stream(spark, source), target, state)
    assert spark.read.parquet(target).count() == 2
    again = first.withColumn("id", F.col("id") + 10).withColumn("source_url", F.when(F.col("id") == 12, "https://u/2").otherwise(F.col("source_url")))
    again.coalesce(1).write.mode("append").parquet(source)
    ingest(listing_stream(spark, source), target, state)
    got = spark.read.parquet(target)
    assert got.where("source_url = 'https://u/1'").count() == 1 and got.where("source_url = 'https://u/2'").count() == 1
    assert {r.id for r in got.where("source_url = ''").collect()} == {3, 13}


def test_a_batch_reads_the_addresses_of_its_cities_only(spark, tmp_path):
    path = str(tmp_path / "raw")
    cities = ["T", "U", "Орёл / 1", None]
    rows = [(i, cities[i % 4], f"https://u/{i}") for i in range(40)]
    spark.createDataFrame(rows, "id long, city string, source_url string").write.partitionBy("city").parquet(path)
    stored = spark.read.schema("city string, id long, source_url string").parquet(path)
    batch = listing_table(spark, [listing(100 + i, city=c) for i, c in enumerate([None, "Орёл / 1", "Орёл / 1", "New"])])
    batch = batch.withColumn("source_url", F.when(F.col("id") == 101, "https://u/2").otherwise(F.concat(F.lit("https://n/"), "id")))
    pruned = of_same_scopes(stored, batch)
    assert {r.city for r in pruned.collect()} == {"Орёл / 1", None}
    assert {r.city for r in of_same_scopes(stored, batch.where("city IS NOT NULL")).collect()} == {"Орёл / 1"}
    assert "PartitionFilters: [(city" in pruned._jdf.queryExecution().toString()
    assert sum("city=T" in f or "city=U" in f for f in (r[0] for r in pruned.select("_metadata.file_path").distinct().collect())) == 0
    assert {r.id for r in new_listings(batch, pruned).collect()} == {r.id for r in new_listings(batch, stored).collect()} == {100, 102, 103}


def test_scoped_table_rewrites_only_touched_cities(spark, tmp_path):
    store = ScopedTable(spark, str(tmp_path / "scoped"))
    assert store.read() is None and store.scopes() == []
    rows = [(1, "T", "a"), (2, "U", "b"), (3, "Орёл / 1", "c")]
    store.upsert(spark.createDataFrame(rows, "id long, city string, v string"))
    assert store.scopes() == ["T", "U", "Орёл / 1"]
    untouched = sorted(glob.glob(str(tmp_path / "scoped/city=U/*.parquet")))
    store.upsert(spark.createDataFrame([(1, "T", "z"), (4, "T", "n"), (3, "Орёл / 1", None)], "id long, city string, v string"))
    assert sorted((r.id, r.v) for r in store.read().collect()) == [(1, "z"), (2, "b"), (3, "c"), (4, "n")]
    assert sorted(glob.glob(str(tmp_path / "scoped/city=U/*.parquet"))) == untouched
    store.delete_scopes(["Орёл / 1", "T"])
    assert [r.id for r in store.read().collect()] == [2] and store.read(["T"]).count() == 0


def test_a_run_drops_its_own_tables_only(spark):
    with scratch_dropped_after():
        outer = keep(spark.range(3), "outer")
        with scratch_dropped_after():
            inner = keep(spark.range(4), "inner")
        assert outer.df.count() == 3 and not os.path.isdir(inner.path.removeprefix("file:"))
    assert not os.path.isdir(outer.path.removeprefix("file:"))


def test_exporting_one_city_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "csv")
    named = scored(spark).withColumn("name", F.concat(F.lit('ООО "'), "name", F.lit('", ')))
    write_csv(named, path)
    write_csv(named.where("city = 'Орёл'").withColumn("name", F.lit("  Lead ")), path)
    rows = {r.id: (r["name"], r.city) for r in read_csv(spark, path).collect()}
    assert rows == {"1": ('ООО "Один", ', "Тверь"), "2": ('ООО "Два|[x]", ', "Тверь"), "3": ('ООО "Три", ', "Тверь"), "4": ("  Lead ", "Орёл")}


def test_scratch_is_dropped_and_stands_in_the_checkpoint_folder(spark, tmp_path):
    with scratch_dropped_after():
        kept = keep(spark.range(5), "probe")
        assert kept.df.count() == 5 and os.path.isdir(kept.path.removeprefix("file:"))
    assert not os.path.isdir(kept.path.removeprefix("file:"))
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert scratch_path(spark, "x").startswith(configured or spark.sparkContext.getCheckpointDir())
