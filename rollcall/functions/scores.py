"""Rule dicts compiled to Columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.settings import FALLBACK_LEVELS, LEVELS, MODERN_CMS, WEIGHTS


def _count_of(df: DataFrame, counter: str, values: str) -> Column:
    """Stored count where the table carries one, else the size of the list."""
    if counter in df.columns:
        return F.coalesce(F.col(counter), F.lit(0))
    return F.coalesce(F.size(F.col(values)), F.lit(0))


def _link(kind: str) -> Column:
    return F.coalesce(F.try_element_at(F.col("messengers"), F.lit(kind)), F.lit("")) != ""


def score_of(df: DataFrame, weights: dict[str, int] = WEIGHTS) -> Column:
    """Sum of weights. Builder and widget count only with a website, trust only with Telegram."""
    weight = {name: int(weights.get(name, 0)) for name in WEIGHTS}
    website = F.coalesce(F.col("website"), F.lit("")) != ""
    trust = F.coalesce(F.col("tg_trust.trust_score"), F.lit(0))
    parts = [
        F.when(website, F.lit(weight["has_website"])),
        F.when(website & (F.col("cms") == "bitrix"), F.lit(weight["cms_bitrix"])),
        F.when(website & F.col("cms").isin(*MODERN_CMS), F.lit(weight["cms_modern"])),
        F.when(website & F.col("has_marquiz"), F.lit(weight["has_marquiz"])),
        F.when(_link("telegram"), F.lit(weight["has_telegram"]) + trust * weight["tg_trust_multiplier"]),
        F.when(_link("whatsapp"), F.lit(weight["has_whatsapp"])),
        F.when(_count_of(df, "n_phones", "phones") > 1, F.lit(weight["multiple_phones"])),
        F.when(_count_of(df, "n_emails", "emails") > 0, F.lit(weight["has_email"])),
        F.when(F.col("is_network"), F.lit(weight["is_network"])),
    ]
    return reduce(lambda a, b: a + b, [F.coalesce(p, F.lit(0)) for p in parts]).cast("int")


def segment_of(score: Column, levels: dict[str, int] = LEVELS) -> Column:
    level = {name: int(levels.get(name, FALLBACK_LEVELS[name])) for name in FALLBACK_LEVELS}
    return (
        F.when(score >= level["segment_A"], "A")
        .when(score >= level["segment_B"], "B")
        .when(score >= level["segment_C"], "C")
        .otherwise("D")
    )
