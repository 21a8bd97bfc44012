"""What a user calls: run, export and export by preset, for one city or all, over a folder of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from rollcall.operators.merge import EMAIL, PHONE
from rollcall.operators.picking import with_dense_ids
from rollcall.operators.places import COPY_IDS, region_cities, relabel_scope
from rollcall.operators.presets import apply_preset
from rollcall.operators.site_scan import visit_details
from rollcall.operators.stages import stage_by_city
from rollcall.plans.full_run import Finished, Rules, refill, run
from rollcall.schema import LISTING
from rollcall.scratch import keep, scratch_dropped_after
from rollcall.settings import PRESETS
from rollcall.sinks.reports import FURTHER, conflicts_report, export_all, export_preset, further_rows, markdown_lines, write_csv, write_further, write_lines
from rollcall.sinks.tables import ScopedTable, drop_other_scopes, stored_columns, write_batch
from rollcall.sources.registry import READERS, collect_sources
from rollcall.streaming.ingest import ingest, listing_stream, new_rows, of_same_scopes

INPUTS = {
    "pages": "url string, status int, html string",
    "profiles": "url string, html string",
    "hits": "city string, query_name string, pos int, url string, title string",
    "details": "url string, emails array<string>, phones array<string>, messengers map<string,string>, cms string",
    "fetched": "url string, output string",
}

# Stored inputs of the listing sources, below ``sources``.
SOURCE_INPUTS = {
    "jsprav": "category string, city string, page int, url string, html string",
    "firecrawl": "city string, query string, body string",
    "fetched": "url string, output string",
    **dict.fromkeys(("dgis", "yell", "firmsru", "jsprav_playwright"), "city string, url string, html string"),
}


# Dimensions of towns: of ``region_cities``.
DIMENSIONS = {"cities": "name string, region string", "region_city": "region string, town string"}


class Workspace:
    """Tables under one root: ``incoming`` listing files, the stored inputs, and what runs make of them.

    ``raw`` holds the listings, ``labelled`` and ``deduped`` what grouping made of them, ``companies`` one row per company,
    ``facts`` all their phones, e-mails and listing ids; ``export`` the reports.
    """

    def __init__(self, spark: SparkSession, root: str, rules: Rules = Rules()):
        self.spark, self.root, self.rules = spark, root.rstrip("/"), rules
        self.raw = ScopedTable(spark, f"{self.root}/raw", schema=StructType([*LISTING.fields, StructField("batch", StringType())]))
        self.labelled = ScopedTable(spark, f"{self.root}/labelled")
        self.deduped = ScopedTable(spark, f"{self.root}/deduped")
        self.companies = ScopedTable(spark, f"{self.root}/companies")
        self.facts = ScopedTable(spark, f"{self.root}/facts")

    def input(self, name: str) -> DataFrame:
        """A stored input, or an empty table while there is none."""
        found = stored_columns(self.spark, f"{self.root}/{name}", INPUTS[name])
        return self.spark.createDataFrame([], INPUTS[name]) if found is None else found

    def cities(self, city: str = "all") -> list[str]:
        return self.raw.scopes() if city.lower() == "all" else [city]

    @staticmethod
    def _wanted(city: str) -> list[str] | None:
        """Filter for reading a table: none for all cities."""
        return None if city.lower() == "all" else [city]

    def stages(self) -> DataFrame:
        empty = self.spark.createDataFrame([], "city string")
        raw, deduped, companies = (empty if t is None else t.select("city") for t in (x.read() for x in (self.raw, self.deduped, self.companies)))
        return stage_by_city(raw.union(deduped).union(companies), raw, deduped, companies)

    def towns(self, wanted: list[str]) -> DataFrame | None:
        """(town, city) for the wanted cities, from the stored dimensions ``cities`` and ``region_city``, if there are any."""
        dimensions = [stored_columns(self.spark, f"{self.root}/{name}", schema) for name, schema in DIMENSIONS.items()]
        if any(d is None for d in dimensions):
            return None
        return region_cities(self.spark.createDataFrame([(c,) for c in wanted], "city string"), *dimensions)

    def collect(self, towns: DataFrame | None = None, flags: dict[str, dict] | None = None) -> dict[str, str]:
        """Takes in new listing files and the listings of the stored source pages; returns the errors of failed sources.

        ``towns`` (town, city) puts towns under the city they belong to.
        """
        stream = listing_stream(self.spark, f"{self.root}/incoming")
        if stored_columns(self.spark, f"{self.root}/incoming", "id long") is not None:
            ingest(stream if towns is None else relabel_scope(stream, towns), self.raw.path, f"{self.root}/state")
        stored = {name: stored_columns(self.spark, f"{self.root}/sources/{name}", schema) for name, schema in SOURCE_INPUTS.items()}
        present = {name: df for name, df in stored.items() if df is not None}
        if "firecrawl" in present:
            present.setdefault("fetched", self.spark.createDataFrame([], SOURCE_INPUTS["fetched"]))
        names = tuple(name for name in READERS if name in present)
        if not names:
            return {}
        found, errors = collect_sources(present, flags, names)
        if found is not None:
            self.add(found if towns is None else relabel_scope(found, towns))
        return errors

    def add(self, rows: DataFrame) -> None:
        """Appends collected listings without ids that are not stored yet, numbered after the highest stored id."""
        stored = self.raw.read()
        highest = None if stored is None else stored.where(F.col("id") < COPY_IDS).agg(F.max("id")).first()[0]
        start = 0 if highest is None else highest + 1
        fresh = keep(new_rows(rows, stored if stored is None else of_same_scopes(stored, rows)), "collected").df
        write_batch(with_dense_ids(fresh, start=start), self.raw.path, f"a{start}")

    def _store(self, finished: Finished, cities: list[str]) -> None:
        """Replaces the companies and facts of the cities, both computed before the first is written."""
        companies = keep(finished.companies, "new-companies").df
        facts = keep(finished.facts.join(companies.select("id", "city"), "id"), "new-facts").df
        present = [r[0] for r in companies.select("city").distinct().collect()]
        for table, rows in ((self.facts, facts), (self.companies, companies)):
            table.replace(rows)
            table.delete_scopes([c for c in cities if c not in present])

    def run(
        self,
        city: str = "all",
        force: bool = False,
        no_scrape: bool = False,
        re_enrich: bool = False,
        towns: DataFrame | None = None,
        flags: dict[str, dict] | None = None,
        export: bool = False,
    ) -> list[str]:
        """Brings cities up to date in one job and returns them.

        ``force`` groups their listings and rebuilds their companies from nothing, as is needed when the scope of the rules
        changes; else listings join the stored groups. ``no_scrape`` takes in nothing new;
        ``re_enrich`` only fills gaps of companies that exist. Networks, scores and segments are always
        computed afresh, companies that exist are not visited again. ``towns`` says which towns count to which city, by default
        those of the stored regions; ``flags`` switches sources off; ``export`` writes all reports at the end.
        """
        with scratch_dropped_after():
            if not no_scrape and not re_enrich:
                if towns is None and city.lower() != "all":
                    towns = self.towns([city])
                self.collect(towns, flags)
            cities = self.cities(city)
            wanted = self._wanted(city)
            known, facts = self.companies.read(wanted), self.facts.read(wanted)
            listings = self.raw.read(wanted)
            inputs = {name: self.input(name) for name in INPUTS}
            if re_enrich and known is not None:
                named = known.select("id", F.col("name").alias("query_name"), "city")
                hits = inputs["hits"].join(named, ["query_name", "city"]).select("id", "pos", "url", "title")
                details = inputs["details"].unionByName(visit_details(inputs["fetched"], inputs["pages"]))
                self._store(refill(known, hits, details, self.rules, facts.drop("city")), cities)
            elif not re_enrich and listings is not None:
                before = None if force else known
                finished = run(
                    listings,
                    **inputs,
                    already=before,
                    rules=self.rules,
                    already_facts=None if before is None else facts.drop("city"),
                    on_resolved=self._store_groups,
                    grouped=None if force else self._groups(wanted),
                )
                self._store(finished, cities)
        if export:
            self.export_everything(city)
        return cities

    def _groups(self, wanted: list[str] | None) -> DataFrame | None:
        """The labelled listings of earlier runs, which say by themselves what is grouped already."""
        stored = self.labelled.read(wanted)
        return stored if stored is not None and set(self.rules.scope) <= set(stored.columns) else None

    def _store_groups(self, labelled: DataFrame, companies: DataFrame) -> None:
        self.labelled.replace(labelled)
        self.deduped.replace(companies)

    def clear(self, city: str) -> None:
        """Removes listings and companies of a city."""
        for table in (self.raw, self.labelled, self.deduped, self.companies, self.facts):
            table.delete_scopes([city])

    def _written(self, rows: DataFrame, path: str, city: str) -> str:
        """Clears what an earlier export left of cities that have nothing to report now."""
        present = [r[0] for r in rows.select("city").distinct().collect()]
        drop_other_scopes(self.spark, path, present, self._wanted(city))
        return path

    def _further(self, companies: DataFrame, city: str, *paths: str) -> DataFrame | None:
        """The values that the lists of companies end before, from the stored facts, to be written beside the reports at ``paths``.

        What earlier exports wrote there for these cities is removed first, as the lists of a city may all be whole now.
        """
        for path in paths:
            drop_other_scopes(self.spark, path + FURTHER, [], self._wanted(city))
        facts = self.facts.read(self._wanted(city))
        return None if facts is None else further_rows(companies, facts, self.rules.listed)

    def export(self, city: str = "all", format: str = "csv") -> str | None:
        """Writes the companies of the cities as ``csv`` or ``md`` and returns the folder. Other cities stay as they are.

        A row lists the first values of a company; those it does not hold stand in a folder beside the report.
        """
        rows = self.companies.read(self._wanted(city))
        if rows is None:
            return None
        path = f"{self.root}/export/{'report' if format == 'md' else 'enriched'}"
        if format == "md":
            write_lines(markdown_lines(rows), path)
        else:
            write_csv(rows, path)
        with scratch_dropped_after():
            further = self._further(rows, city, path)
            if further is not None:
                write_further(further, path, (PHONE,) if format == "md" else (PHONE, EMAIL))
        return self._written(rows, path, city)

    def conflicts(self, city: str = "all") -> str | None:
        """Writes the companies whose listings name several streets for review and returns the folder."""
        labelled, companies = self.labelled.read(self._wanted(city)), self.deduped.read(self._wanted(city))
        if labelled is None or companies is None:
            return None
        with scratch_dropped_after():
            path = conflicts_report(labelled, companies, f"{self.root}/export/conflicts")
        return self._written(companies.where("needs_review"), path, city)

    def export_preset(self, preset: str, city: str = "all", presets: dict[str, dict] = PRESETS) -> str | None:
        if preset not in presets:
            raise KeyError(f"no preset {preset}; there are {', '.join(presets)}")
        rows = self.companies.read(self._wanted(city))
        if rows is None:
            return None
        with scratch_dropped_after():
            further = self._further(rows, city, f"{self.root}/export/{preset}")
            path = export_preset(rows, preset, presets[preset], f"{self.root}/export", further=further)
        return self._written(apply_preset(rows, presets[preset].get("filters")), path, city)

    def export_everything(self, city: str = "all", presets: dict[str, dict] = PRESETS) -> dict[str, str]:
        """Writes all companies, every preset and the conflicts; the error text where one of them failed."""
        rows = self.companies.read(self._wanted(city))
        if rows is None:
            return {}
        with scratch_dropped_after():
            further = self._further(rows, city, *(f"{self.root}/export/{name}" for name in ("enriched", *presets)))
            done = export_all(rows, f"{self.root}/export", presets, further=further)
        for name, path in done.items():
            if not path.startswith("error"):
                self._written(rows if name not in presets else apply_preset(rows, presets[name].get("filters")), path, city)
        conflicts = self.conflicts(city)
        return done if conflicts is None else done | {"conflicts": conflicts}
