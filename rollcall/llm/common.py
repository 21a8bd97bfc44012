"""What the operators share: reading tables, intermediate tables, word counts, random numbers from ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.scratch import scratch_path

#: A word: a run of anything but ASCII white space. The same in Java, DuckDB and Python.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: later jobs neither repeat nor depend on its plan."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Most bytes of one Arrow batch of texts. A worker and its executor each hold a few copies of a batch.
BATCH_BYTES = 4 << 20


def to_python(df: DataFrame) -> DataFrame:
    """``df``, whose texts go to Python next: bounds the Arrow batches of its session."""
    spark, key = df.sparkSession, "spark.sql.execution.arrow.maxBytesPerBatch"
    bound = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
    if bound > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))
    return df


def words_in(text: str | Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def digest_bits(key: Column, digits: int) -> Column:
    """The first hexadecimal digits of the MD5 of a key's text as a long. Null keys count as empty text."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, digits), 16, 10).cast("long")


def uniform(key: Column, seed: str = "") -> Column:
    """A number inside (0, 1) that depends on the key and the seed only."""
    salted = F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(seed))
    return (digest_bits(salted, 13) + F.lit(0.5)) / F.lit(float(2**52))
