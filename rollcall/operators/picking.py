"""First row per key and numbering within a key, both safe for keys that hold much of the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rollcall.scratch import keep


def first_per_key(df: DataFrame, keys: list[str], *order: str | Column) -> DataFrame:
    """The first row of each key in the given order.

    An aggregate with partial combine, so a hot key shrinks to one row per input
    partition before the shuffle. A window would sort the whole key in one task.
    """
    ranks = [F.col(o) if isinstance(o, str) else o for o in order]
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[r.alias(f"r{i}") for i, r in enumerate(ranks)])
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), rank).alias("picked"))
    return picked.select(*keys, "picked.*").select(*df.columns)


def numbered(df: DataFrame, keys: list[str], order: str | list[str], name: str) -> DataFrame:
    """Adds the position (from 1) of each row within its key, in the order of the columns ``order``.

    Rows are dealt by ranges that Spark takes from the data, so a key that holds much of them is spread over many
    tasks wherever its values lie. Rows are counted inside (key, range) and offset by the counts of the key's
    ranges before. The dealt rows are written once, so both counts see the same ranges.
    """
    by = [order] if isinstance(order, str) else order
    dealt = keep(df.repartitionByRange(*keys, *by).withColumn("range", F.spark_partition_id()), "ranges").df
    inside = Window.partitionBy(*keys, "range").orderBy(*by)
    before = Window.partitionBy(*keys).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy(*keys, "range")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(*keys, "range", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    )
    return (
        dealt.withColumn("within", F.row_number().over(inside))
        .join(offsets, [*keys, "range"])
        .select(*df.columns, (F.col("offset") + F.col("within")).cast("long").alias(name))
    )


def with_dense_ids(df: DataFrame, name: str = "id", start: int = 0, buckets: int = 65536) -> DataFrame:
    """Adds ids ``start``, ``start`` + 1, .. that depend on the rows only, not on their order or partitions.

    Equal rows are counted before they are shuffled. Distinct rows are dealt by a hash of all their columns into buckets,
    put in order inside a bucket by two further hashes, and take as many ids in a row as they have copies, from
    the counts of the buckets before on. The counted rows are written once.
    """
    text = F.to_json(F.struct(*df.columns))
    hashed = df.select(F.struct(*df.columns).alias("row"), F.xxhash64(text).alias("h1"), F.md5(text).alias("h2"))
    counted = hashed.groupBy("h1", "h2").agg(F.first("row").alias("row"), F.count(F.lit(1)).alias("copies"))
    stored = keep(counted.withColumn("bucket", F.pmod("h1", F.lit(buckets))), "distinct").df
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        stored.groupBy("bucket")
        .agg(F.sum("copies").alias("rows"))
        .select("bucket", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    )
    inside = Window.partitionBy("bucket").orderBy("h1", "h2").rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("offset") + F.coalesce(F.sum("copies").over(inside), F.lit(0)) + F.lit(start)
    return (
        stored.join(offsets, "bucket")
        .withColumn("first", first)
        .select(F.explode(F.sequence("first", F.col("first") + F.col("copies") - 1)).alias(name), "row")
        .select(F.col(name).cast("long").alias(name), "row.*")
    )
