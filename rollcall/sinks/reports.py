"""CSV, Markdown, JSON and conflict reports.

Row and line shapes are DataFrames; writers sort them by range, so the part files of
a report follow one another and no single task holds a whole city.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from rollcall.functions.texts import escape_markdown, variant_label
from rollcall.operators.linkage import SCOPE
from rollcall.operators.merge import EMAIL, PHONE, further_values
from rollcall.operators.picking import numbered
from rollcall.operators.presets import apply_preset
from rollcall.scratch import keep
from rollcall.settings import PRESETS

log = logging.getLogger(__name__)

BYTE_ORDER_MARK = "\ufeff"

# Columns of the CSV export.
CSV_COLUMNS = (
    "id", "name", "phones", "address", "website", "emails", "segment", "crm_score", "is_network", "cms", "has_marquiz", "telegram", "vk", "whatsapp",
)

# Words of the Markdown reports.
REPORT_TITLE = "# База мастерских: "
FILTER_LINE = "**Фильтр:** "
TOTAL_LINE = "**Всего компаний:** "
SEGMENT_LINE = "## Сегмент "
PIECES = " шт."
TABLE_HEAD = "| Название | Телефон | Сайт | Telegram | CMS | Score |"
TABLE_RULE = "|----------|---------|------|----------|-----|-------|"
SITE_LABEL, TELEGRAM_LABEL = "Сайт", "TG"
CONFLICT_TITLE = "# Конфликты дедупликации — "
CONFLICT_TOTAL = "**Найдено конфликтов:** "
CONFLICT_HELP = "Для каждого конфликта отметьте правильный вариант `[x]`:"
CONFLICT_HEAD = "Конфликт #"
CONFLICT_REASON = "**Причина:** "
CONFLICT_VARIANT = "Вариант "
CONFLICT_FIELDS = ("Адрес", "Телефон", "Сайт", "Источник")
CONFLICT_APART = "- [ ] **Разные компании** (не объединять)"


def _link(kind: str) -> Column:
    return F.coalesce(F.try_element_at("messengers", F.lit(kind)), F.lit(""))


def csv_rows(scored: DataFrame, scope: tuple[str, ...] = SCOPE) -> DataFrame:
    """The fourteen export columns, the scope columns kept in front."""
    yes = lambda name: F.when(F.col(name), "Yes").otherwise("No")
    blank = F.lit("")
    return scored.select(
        *scope,
        "id",
        "name",
        F.array_join("phones", "; ").alias("phones"),
        F.coalesce("address_raw", blank).alias("address"),
        F.coalesce("website", blank).alias("website"),
        F.array_join("emails", "; ").alias("emails"),
        F.coalesce("segment", blank).alias("segment"),
        F.coalesce("crm_score", F.lit(0)).alias("crm_score"),
        yes("is_network").alias("is_network"),
        F.coalesce("cms", blank).alias("cms"),
        yes("has_marquiz").alias("has_marquiz"),
        _link("telegram").alias("telegram"),
        _link("vk").alias("vk"),
        _link("whatsapp").alias("whatsapp"),
    )


def markdown_lines(
    scored: DataFrame, scope: str = "city", preset: str | None = None, description: str | None = None
) -> DataFrame:
    """(city, section, rank, id, line): report lines in the order of the columns before ``line``.

    Section 0 is the head of a report, 1 to 4 are the segments A to D; any other segment goes to D.
    """
    place = F.col(scope)
    capital = F.concat(F.upper(F.substring(place, 1, 1)), F.lower(F.substring(place, F.lit(2), F.length(place))))
    segment = F.when(F.col("segment").isin("A", "B", "C"), F.col("segment")).otherwise("D")
    tagged = scored.withColumns({"letter": segment, "section": F.ascii(segment) - 64})
    site = F.coalesce("website", F.lit(""))
    telegram = _link("telegram")
    row = F.concat(
        F.lit("| **"),
        escape_markdown(F.col("name")),
        F.lit("** | "),
        F.array_join("phones", "<br>"),
        F.lit(" | "),
        F.when(site != "", F.concat(F.lit(f"[{SITE_LABEL}]("), escape_markdown(site), F.lit(")"))).otherwise("-"),
        F.lit(" | "),
        F.when(telegram != "", F.concat(F.lit(f"[{TELEGRAM_LABEL}]("), escape_markdown(telegram), F.lit(")"))).otherwise("-"),
        F.lit(" | "),
        F.coalesce("cms", F.lit("-")),
        F.lit(" | "),
        F.coalesce("crm_score", F.lit(0)).cast("string"),
        F.lit(" |"),
    )
    rows = tagged.select(
        scope, "section", (-F.coalesce("crm_score", F.lit(0))).cast("long").alias("rank"), "id", row.alias("line")
    )

    def lines(df: DataFrame, section: Column, *texts: Column) -> DataFrame:
        """Lines in front of the rows of a section: ranked below every score, numbered by ``id``."""
        entries = F.array(*texts)
        return df.select(scope, section.cast("int").alias("section"), F.posexplode(entries).alias("id", "line")).select(
            scope, "section", F.lit(-(2**40)).alias("rank"), F.col("id").cast("long").alias("id"), "line"
        )

    totals = scored.groupBy(scope).agg(F.count(F.lit(1)).alias("n"))
    title = F.concat(F.lit(REPORT_TITLE), capital, F.lit(f" — {preset}" if preset else ""))
    about = [F.lit(FILTER_LINE + description), F.lit("")] if description else []
    total = F.concat(F.lit(TOTAL_LINE), F.col("n").cast("string"))
    head = lines(totals, F.lit(0), title, F.lit(""), *about, total, F.lit(""))
    counts = tagged.groupBy(scope, "letter", "section").agg(F.count(F.lit(1)).alias("n"))
    heading = F.concat(F.lit(SEGMENT_LINE), "letter", F.lit(" ("), F.col("n").cast("string"), F.lit(PIECES + ")"))
    opening = lines(counts, F.col("section"), heading, F.lit(""), F.lit(TABLE_HEAD), F.lit(TABLE_RULE))
    closing = counts.select(
        scope, F.col("section").cast("int").alias("section"), F.lit(2**40).alias("rank"), F.lit(0).cast("long").alias("id"), F.lit("").alias("line")
    )
    return rows.unionByName(head).unionByName(opening).unionByName(closing)


def conflict_lines(labelled: DataFrame, companies: DataFrame, scope: str = "city") -> DataFrame:
    """(city, number, variant, pos, line): the review report of companies whose listings name several streets.

    Companies are numbered by id within a city, variants lettered by listing id within a company.
    """
    flagged = companies.where("needs_review").select(F.col("id").alias("entity"), scope, "review_reason")
    ordered = numbered(flagged, [scope], "entity", "number")
    members = labelled.join(ordered.select("entity", "number"), "entity")
    variants = numbered(members, ["entity"], "id", "variant")
    missing = F.lit("N/A")
    values = (
        F.coalesce("address_raw", missing),
        F.array_join("phones", ", "),
        F.coalesce("website", missing),
        F.coalesce("source", missing),
    )
    body = [
        F.concat(
            F.lit(f"- [ ] **{CONFLICT_VARIANT}"),
            variant_label(F.col("variant") - 1),
            F.lit(":** "),
            F.coalesce("name", missing),
        ),
        *[F.concat(F.lit(f"  {label}: "), value) for label, value in zip(CONFLICT_FIELDS, values)],
        F.concat(F.lit("  ID: "), F.col("id").cast("string")),
        F.lit(""),
    ]

    def spread(df: DataFrame, number: Column, variant: Column, texts: list[Column]) -> DataFrame:
        return df.select(
            scope, number.cast("long").alias("number"), variant.cast("long").alias("variant"), F.posexplode(F.array(*texts)).alias("pos", "line")
        )

    number = F.col("number")
    opening = spread(
        ordered,
        number,
        F.lit(0),
        [
            F.concat(F.lit("## "), number.cast("string"), F.lit(f". {CONFLICT_HEAD}"), F.col("entity").cast("string")),
            F.lit(""),
            F.concat(F.lit(CONFLICT_REASON), F.col("review_reason")),
            F.lit(""),
        ],
    )
    closing = spread(ordered, number, F.lit(2**62), [F.lit(CONFLICT_APART), F.lit(""), F.lit("---"), F.lit("")])
    totals = flagged.groupBy(scope).agg(F.count(F.lit(1)).alias("n"))
    head = spread(
        totals,
        F.lit(0),
        F.lit(0),
        [
            F.concat(F.lit(CONFLICT_TITLE), F.col(scope)),
            F.lit(""),
            F.concat(F.lit(CONFLICT_TOTAL), F.col("n").cast("string")),
            F.lit(""),
            F.lit(CONFLICT_HELP),
            F.lit(""),
            F.lit("---"),
            F.lit(""),
        ],
    )
    return head.unionByName(opening).unionByName(spread(variants, number, F.col("variant"), body)).unionByName(closing)


def _by_city(rows: DataFrame, scope: str, order: list[str | Column]) -> DataFrameWriter:
    """A writer of one folder per city, files in order, that replaces the cities it writes and no others.

    Folders carry the city itself; Spark escapes what a file name can't hold.
    """
    ranged = rows.repartitionByRange(scope, *order).sortWithinPartitions(scope, *order)
    return ranged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(scope)


def write_csv(scored: DataFrame, path: str, scope: str = "city", literal_header: bool = True) -> None:
    """One folder per city, best companies first. Each file opens with a byte order mark and a header.

    Quotes are doubled and blanks kept, as RFC 4180 has it.
    """
    rows = csv_rows(scored, (scope,))
    header = BYTE_ORDER_MARK + "id" if literal_header else "id"
    named = rows.withColumnRenamed("id", header)
    _by_city(named, scope, [F.desc("crm_score"), F.col(header)]).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path, header=True)


def read_csv(spark: SparkSession, path: str, scope: str = "city") -> DataFrame:
    """What ``write_csv`` wrote, all columns as text, with the city of the folder."""
    names = [*CSV_COLUMNS, scope]
    return spark.read.schema(", ".join(f"{n} string" for n in names)).option("header", True).option("escape", '"').option("multiLine", True).csv(path)


def write_lines(lines: DataFrame, path: str, scope: str = "city") -> None:
    """One folder of text files per city; read in file order they are the report."""
    order = [c for c in lines.columns if c not in (scope, "line")]
    ranged = lines.repartitionByRange(scope, *order).sortWithinPartitions(scope, *order).select(scope, "line")
    ranged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(scope).text(path)


def write_json(scored: DataFrame, path: str, scope: str = "city") -> None:
    scored.hint("rebalance", scope).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(scope).json(path)


def conflicts_report(labelled: DataFrame, companies: DataFrame, path: str, scope: str = "city") -> str:
    write_lines(conflict_lines(labelled, companies, scope), path, scope)
    return path


#: What the folder of the values that a report's rows do not hold is called after the report.
FURTHER = "_further"
FURTHER_COLUMNS = ("id", "kind", "place", "value")


def further_rows(companies: DataFrame, facts: DataFrame, limit: int | None = None, scope: str = "city") -> DataFrame:
    """(city, id, kind, place, value): values of companies after the first ``limit`` of a kind, which their lists end at. None without a limit."""
    own = facts.select("id", "kind", "value", "first_id", "pos")
    return further_values(own, limit).join(companies.select("id", scope), "id").select(scope, *FURTHER_COLUMNS)


def write_further(rows: DataFrame, path: str, kinds: tuple[str, ...] | None = None, scope: str = "city") -> None:
    """Writes what a report's rows do not hold beside it: one folder per city, in the order of company, kind and place.

    A long list is dealt by ranges of its places over several files. With ``kinds`` other kinds of values stay out.
    """
    wanted = rows if kinds is None else rows.where(F.col("kind").isin(*kinds))
    _by_city(wanted, scope, ["id", "kind", "place"]).option("escape", '"').csv(path + FURTHER, header=True)


def read_further(spark: SparkSession, path: str, scope: str = "city") -> DataFrame:
    """What ``write_further`` wrote beside the report at ``path``."""
    schema = f"id long, kind string, place long, value string, {scope} string"
    return spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", True).csv(path + FURTHER)


def export_preset(scored: DataFrame, name: str, preset: dict, folder: str, literal: bool = False, further: DataFrame | None = None) -> str:
    """Writes the companies of one preset in its format and returns the path.

    ``literal`` writes everything but Markdown as CSV. ``further`` (see ``further_rows``) are the values that do not fit into the
    lists of the companies; those a report of its format would show are written beside it.
    """
    chosen = apply_preset(scored, preset.get("filters"), literal)
    kind = preset.get("format", "csv")
    path = f"{folder}/{name}"
    shown: tuple[str, ...] | None = (PHONE, EMAIL)
    if kind in ("markdown", "md"):
        shown = (PHONE,)
        write_lines(markdown_lines(chosen, preset=name, description=preset.get("description")), path)
    elif kind == "json" and not literal:
        shown = None
        write_json(chosen, path)
    else:
        write_csv(chosen, path)
    if further is not None:
        write_further(further.join(chosen.select("id"), "id", "left_semi"), path, shown)
    return path


def export_all(
    scored: DataFrame, folder: str, presets: dict[str, dict] = PRESETS, literal: bool = False, further: DataFrame | None = None
) -> dict[str, str]:
    """Writes all companies and every preset. A preset that fails is logged and the others go on.

    Returns the path, or the error text, of each export. ``scored`` should be a stored table: it is read once
    per export. ``further`` is as in ``export_preset``.
    """
    done: dict[str, str] = {}
    more = None if further is None else keep(further, "further")

    def everything() -> None:
        write_csv(scored, f"{folder}/enriched")
        if more is not None:
            write_further(more.df, f"{folder}/enriched", (PHONE, EMAIL))

    jobs = {"enriched": everything}
    for name, preset in presets.items():
        jobs[name] = lambda name=name, preset=preset: export_preset(scored, name, preset, folder, literal, None if more is None else more.df)
    for name, job in jobs.items():
        try:
            job()
            done[name] = f"{folder}/{name}"
        except Exception as error:
            log.exception("export %s failed", name)
            done[name] = f"error: {error}"
    if more is not None:
        more.drop()
    return done
