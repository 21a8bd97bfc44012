"""One query per operator over the driver's tables, with its production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rollcall.llm.collocations import collocations_sql, phrase_report
from rollcall.llm.common import table
from rollcall.llm.contamination import contamination_digest, contamination_sql
from rollcall.llm.divergence import divergence_sql, source_divergence
from rollcall.llm.licenses import license_matches, licenses_sql
from rollcall.llm.mainhtml import main_text
from rollcall.llm.mixing import mix, mixing_sql
from rollcall.llm.packing import pack
from rollcall.llm.pivots import near_duplicates
from rollcall.llm.sharding import sharding_sql, shards
from rollcall.llm.simhash import simhash_components
from rollcall.llm.tokenids import token_digests
from rollcall.llm.topk import top_k, topk_sql
from rollcall.llm.toxicity import toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": lambda spark, folder: toxicity(table(spark, folder, "documents"), table(spark, folder, "labels")),
    "op2_topk": lambda spark, folder: top_k(embeddings := table(spark, folder, "embeddings"), embeddings.where("vec_id % 50 = 0")),
    "op3_mixing": lambda spark, folder: mix(table(spark, folder, "documents")),
    "op4_sharding": lambda spark, folder: shards(table(spark, folder, "documents")),
    "op5_simhash": lambda spark, folder: simhash_components(table(spark, folder, "documents")),
    "op6_pivots": lambda spark, folder: near_duplicates(table(spark, folder, "embeddings")),
    "op7_packing": lambda spark, folder: pack(table(spark, folder, "documents")),
    "op8_licenses": lambda spark, folder: license_matches(table(spark, folder, "documents")),
    "op9_token_ids": lambda spark, folder: token_digests(table(spark, folder, "documents")),
    "op10_html": lambda spark, folder: main_text(table(spark, folder, "pages")),
    "op11_divergence": lambda spark, folder: source_divergence(table(spark, folder, "documents")),
    "op12_collocations": lambda spark, folder: phrase_report(table(spark, folder, "documents")),
    "op13_contamination": lambda spark, folder: contamination_digest(table(spark, folder, "documents"), table(spark, folder, "benchmark")),
}

SQL: dict[str, str] = {
    "op2_topk": topk_sql(),
    "op3_mixing": mixing_sql(),
    "op4_sharding": sharding_sql(),
    "op8_licenses": licenses_sql(),
    "op11_divergence": divergence_sql(),
    "op12_collocations": collocations_sql(),
    "op13_contamination": contamination_sql(),
}
