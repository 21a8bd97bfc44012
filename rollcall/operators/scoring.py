"""Scores, segments and their reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.scores import score_of, segment_of
from rollcall.operators.linkage import SCOPE
from rollcall.settings import LEVELS, WEIGHTS


def score_companies(
    companies: DataFrame, weights: dict[str, int] = WEIGHTS, levels: dict[str, int] = LEVELS
) -> DataFrame:
    scored = companies.withColumn("crm_score", score_of(companies, weights))
    return scored.withColumn("segment", segment_of(F.col("crm_score"), levels))


def segment_histogram(scored: DataFrame, scope: tuple[str, ...] = SCOPE) -> DataFrame:
    return scored.groupBy(*scope, "segment").agg(F.count(F.lit(1)).alias("companies"))


def top_scored(scored: DataFrame, most: int = 20) -> DataFrame:
    """The best companies; ties go to the lower id."""
    return scored.orderBy(F.desc("crm_score"), "id").limit(most)
