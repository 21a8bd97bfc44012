"""Export presets: conditions as text, joined by AND, evaluated by Spark as they stand."""

from __future__ import annotations

import logging
import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

MESSENGER_NAMES = ("telegram", "whatsapp", "vk", "instagram")

# Conditions the literal mode knows; any other one filters nothing there.
LITERAL_CONDITIONS = (
    r"(telegram|whatsapp)\s+IS\s+(NOT\s+)?NULL",
    r"email\s+IS\s+NOT\s+NULL",
    r"priority_score\s*>=\s*\d+",
)


def with_preset_columns(companies: DataFrame) -> DataFrame:
    """(row, names conditions use): a messenger is null without its key, ``email`` and ``emails`` null when there are none."""
    count = F.col("n_emails") if "n_emails" in companies.columns else F.size("emails")
    named = {name: F.when(F.map_contains_key("messengers", name), F.col("messengers")[name]) for name in MESSENGER_NAMES}
    named |= {c: F.col(c) for c in companies.columns if c not in named}
    named |= {"priority_score": F.col("crm_score")}
    named |= {name: F.when(count > 0, F.col("emails") if "emails" in companies.columns else count) for name in ("email", "emails")}
    return companies.select(F.struct(*companies.columns).alias("row"), *[c.alias(name) for name, c in named.items() if name != "row"])


def literal_conditions(filters: str | None) -> list[str]:
    """The text cut at every AND, as the literal mode reads it."""
    text = (filters or "").strip()
    if text in ("", "1=1"):
        return []
    return [part.strip() for part in re.split(r"\s+AND\s+", text, flags=re.IGNORECASE)]


def conditions_of(spark: SparkSession, filters: str | None) -> list[str]:
    """What Spark's parser joins by AND at the top of the text, each as SQL. Text it can't read is an error."""
    text = (filters or "").strip()
    if not text:
        return []
    found, open_parts = [], [spark._jsparkSession.sessionState().sqlParser().parseExpression(text)]
    while open_parts:
        part = open_parts.pop()
        if part.nodeName() == "And":
            open_parts += [part.right(), part.left()]
        else:
            found.append(part.sql())
    return found


def apply_preset(companies: DataFrame, filters: str | None, literal: bool = False) -> DataFrame:
    """Companies that meet every condition. A condition on a column the table lacks is skipped with a warning."""
    view = with_preset_columns(companies)
    for condition in literal_conditions(filters) if literal else conditions_of(companies.sparkSession, filters):
        if literal and not any(re.match(shape, condition, re.IGNORECASE) for shape in LITERAL_CONDITIONS):
            log.warning("preset condition skipped: %s", condition)
            continue
        try:
            view = view.where(condition)
        except AnalysisException as error:
            if not (error.getCondition() or "").startswith("UNRESOLVED_COLUMN"):
                raise
            log.warning("preset condition on a missing column skipped: %s", condition)
    return view.select("row.*")
