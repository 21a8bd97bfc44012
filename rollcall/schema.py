"""Table schemas and null defaults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names of the collecting sources.
SOURCES = ("firecrawl", "jsprav", "jsprav_playwright", "2gis", "yell", "firmsru", "google_maps", "avito")

GEO = T.StructType([T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())])

TRUST = T.StructType(
    [
        T.StructField("has_avatar", T.BooleanType()),
        T.StructField("has_description", T.BooleanType()),
        T.StructField("is_bot", T.BooleanType()),
        T.StructField("is_channel", T.BooleanType()),
        T.StructField("trust_score", T.IntegerType()),
    ]
)

STRINGS = T.ArrayType(T.StringType())
MESSENGERS = T.MapType(T.StringType(), T.StringType())

LISTING = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("source", T.StringType()),
        T.StructField("source_url", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("phones", STRINGS),
        T.StructField("address_raw", T.StringType()),
        T.StructField("website", T.StringType()),
        T.StructField("emails", STRINGS),
        T.StructField("geo", GEO),
        T.StructField("messengers", MESSENGERS),
        T.StructField("city", T.StringType()),
        T.StructField("scraped_at", T.TimestampType()),
    ]
)

ENRICHED = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("phones", STRINGS),
        T.StructField("address_raw", T.StringType()),
        T.StructField("website", T.StringType()),
        T.StructField("emails", STRINGS),
        T.StructField("city", T.StringType()),
        T.StructField("messengers", MESSENGERS),
        T.StructField("tg_trust", TRUST),
        T.StructField("cms", T.StringType()),
        T.StructField("has_marquiz", T.BooleanType()),
        T.StructField("is_network", T.BooleanType()),
        T.StructField("crm_score", T.IntegerType()),
        T.StructField("segment", T.StringType()),
    ]
)


def no_strings() -> Column:
    return F.array().cast(STRINGS)


def no_messengers() -> Column:
    return F.create_map().cast(MESSENGERS)


def with_null_defaults(df: DataFrame) -> DataFrame:
    """Null lists become empty lists and null maps empty maps."""
    fills = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.ArrayType):
            fills[field.name] = F.coalesce(F.col(field.name), F.array().cast(field.dataType))
        elif isinstance(field.dataType, T.MapType):
            fills[field.name] = F.coalesce(F.col(field.name), F.create_map().cast(field.dataType))
    return df.withColumns(fills) if fills else df


def with_known_source(df: DataFrame) -> DataFrame:
    """Adds ``source_known``: whether ``source`` is one of the collecting sources."""
    return df.withColumn("source_known", F.col("source").isin(*SOURCES))
