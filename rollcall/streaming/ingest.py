"""Incremental ingest of listing files: each listing address of a city once, appended per city."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.operators.picking import first_per_key
from rollcall.schema import LISTING
from rollcall.sinks.tables import stored_columns, write_batch


def listing_stream(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(LISTING).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def listing_key() -> Column:
    """The address of a listing. Rows without one get their id instead, so they all stay."""
    return F.coalesce(F.nullif(F.col("source_url"), F.lit("")), F.concat(F.lit("#"), F.col("id").cast("string")))


def of_same_scopes(stored: DataFrame, rows: DataFrame, scope: str = "city") -> DataFrame:
    """The stored rows of the cities that occur in ``rows``; folders of other cities are not read.

    Cities are a dimension, few next to the listings. Having none counts as a city.
    """
    present = [r[0] for r in rows.select(scope).distinct().collect()]
    named = F.col(scope).isin([c for c in present if c is not None])
    return stored.where(named | F.col(scope).isNull() if None in present else named)


def new_listings(rows: DataFrame, stored: DataFrame | None, scope: str = "city") -> DataFrame:
    """The first row of each address of a city by time and id, without the addresses that are ``stored``."""
    keyed = rows.withColumn("listing_key", listing_key())
    firsts = first_per_key(keyed, [scope, "listing_key"], F.col("scraped_at").isNull(), "scraped_at", "id")
    if stored is not None:
        firsts = firsts.join(stored.select(scope, listing_key().alias("listing_key")), [scope, "listing_key"], "left_anti")
    return firsts.select(*rows.columns)


def new_rows(rows: DataFrame, stored: DataFrame | None) -> DataFrame:
    """The rows that differ from all ``stored`` ones in more than id and time, as pages that are collected again give equal ones."""
    if stored is None:
        return rows
    content = [f.name for f in LISTING.fields if f.name not in ("id", "scraped_at")]
    shown = [F.sort_array(F.map_entries(c)).alias(c) if c == "messengers" else F.col(c) for c in content]
    key = F.md5(F.to_json(F.struct(*shown))).alias("content_key")
    return rows.withColumn("content_key", key).join(stored.select(key), "content_key", "left_anti").select(*rows.columns)


def ingest(stream: DataFrame, path: str, checkpoint: str, scope: str = "city") -> None:
    """Takes in all files that arrived since the last run and returns when they are written.

    An address counts as taken in while the table holds it, however long ago that was, so late listings are kept and late
    repeats are not. A micro-batch that is repeated after a failure replaces its own folders, so every row is stored
    once. The folders hold plain Parquet files: other jobs may add and remove cities beside the stream.
    """

    def take(rows: DataFrame, number: int) -> None:
        batch = f"s{number}"
        stored = stored_columns(rows.sparkSession, path, f"{scope} string, batch string, id long, source_url string")
        others = None if stored is None else of_same_scopes(stored.where(F.col("batch") != batch), rows, scope)
        write_batch(new_listings(rows, others, scope), path, batch, scope)

    query = (
        stream.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
