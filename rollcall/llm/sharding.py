"""Sharding by extendible hashing, in DataFrame functions only.

A document hashes to 63 bits: 32 of its key and 31 of its whole row and place. A bucket is a prefix of those bits. A bucket
over the byte limit splits on the next bit, others stay, until every bucket fits. The directory has one entry for each
prefix of the directory's depth; several entries name the same bucket where that bucket is shallower.

The directory comes from byte sums by prefix, which combine before the shuffle. The first round looks at a depth a little
beyond the one at which the mean bucket fits and finds the leaves of all depths up to it from those sums; buckets that
are still too large go into the next round alone. Rows of one key split on the second part of the hash, so a key
that holds a third of all rows is no exception. A row over the limit by itself is a shard of its own.

Defined results: null and empty texts have 0 bytes; a null key counts as empty text; equal rows differ in their place in
the stored input; an empty table gives no shards. The columns kept are ``doc_id`` and the new ones.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import digest_bits, stored

SHARD_BYTES = 64 << 20
BITS = 63


def _prefix(code: str | Column, depth: int | Column) -> Column:
    shift = F.lit(BITS) - (F.lit(depth) if isinstance(depth, int) else depth)
    return F.call_function("shiftright", F.col(code) if isinstance(code, str) else code, shift.cast("int"))


def _leaves(rows: DataFrame, start: int, depth: int, limit: int) -> DataFrame:
    """(entry, level, bucket, shard_bytes, shard_docs) for each prefix of ``depth`` bits; level is null where none fits."""
    cells = rows.groupBy(_prefix("code", depth).alias("entry")).agg(F.sum("bytes").alias("b"), F.count(F.lit(1)).alias("n"))
    bucket = F.call_function("shiftright", F.col("entry"), (F.lit(depth) - F.col("level")).cast("int"))
    each = cells.select("entry", "b", "n", F.explode(F.sequence(F.lit(start), F.lit(depth))).alias("level")).withColumn("bucket", bucket)
    fitting = (
        each.groupBy("level", "bucket").agg(F.sum("b").alias("shard_bytes"), F.sum("n").alias("shard_docs")).where(F.col("shard_bytes") <= limit)
    )
    found = (
        each.select("entry", "level", "bucket")
        .join(fitting, ["level", "bucket"])
        .groupBy("entry")
        .agg(F.min(F.struct("level", "bucket", "shard_bytes", "shard_docs")).alias("leaf"))
    )
    return cells.select("entry").join(found, "entry", "left").select("entry", "leaf.*")


def shards(docs: DataFrame, limit: int = SHARD_BYTES, key: str = "doc_id") -> DataFrame:
    """(doc_id, bytes, shard, depth, shard_bytes, shard_docs), one row per row of ``docs``.

    ``shard`` is the prefix as a string of bits. A row over the limit has all its bits after a plus sign.
    """
    rows = stored(docs.select("doc_id", _text_bytes("text").alias("bytes"), _code("doc_id", "text", key).alias("code")), "shard-codes")
    return _assigned(rows, "doc_id", limit)


def _text_bytes(text: str) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def _code(doc_id: str, text: str, key: str) -> Column:
    place = F.xxhash64(doc_id, F.xxhash64(text), F.monotonically_increasing_id())
    return F.shiftleft(digest_bits(F.col(f"`{key}`"), 8), 31).bitwiseOR(place.bitwiseAND((1 << 31) - 1))


def _assigned(rows: DataFrame, name: str, limit: int) -> DataFrame:
    """(name, bytes, shard, depth, shard_bytes, shard_docs) for every row of stored (name, bytes, code)."""
    fitting = rows.where(F.col("bytes") <= limit)
    alone = rows.where(F.col("bytes") > limit).select(
        name,
        "bytes",
        F.concat(F.lit("+"), F.lpad(F.bin("code"), BITS, "0")).alias("shard"),
        F.lit(BITS).alias("depth"),
        F.col("bytes").alias("shard_bytes"),
        F.lit(1).cast("long").alias("shard_docs"),
    )
    total = fitting.agg(F.sum("bytes")).first()[0] or 0
    start, depth = 0, min(BITS, max(4, math.ceil(math.log2(max(1, total) / limit + 1)) + 4))
    placed, open_rows = [alone], fitting
    while True:
        leaves = stored(_leaves(open_rows, start, depth, limit if depth < BITS else (1 << 62)), "shard-directory")
        named = leaves.where("level IS NOT NULL").select(
            "entry",
            F.when(F.col("level") > 0, F.expr("lpad(bin(bucket), level, '0')")).otherwise("").alias("shard"),
            F.col("level").alias("depth"),
            "shard_bytes",
            "shard_docs",
        )
        entry = _prefix("code", depth).alias("entry")
        placed.append(open_rows.withColumn("entry", entry).join(named, "entry").select(name, "bytes", "shard", "depth", "shard_bytes", "shard_docs"))
        if leaves.where("level IS NULL").limit(1).count() == 0:
            break
        large = leaves.where("level IS NULL").select("entry")
        open_rows = open_rows.withColumn("entry", entry).join(large, "entry", "left_semi").drop("entry")
        start, depth = depth + 1, min(BITS, depth + 8)
    out = placed[0]
    for more in placed[1:]:
        out = out.unionByName(more)
    return out


def write_shards(docs: DataFrame, path: str, limit: int = SHARD_BYTES) -> None:
    """The rows of ``docs`` as Parquet below ``path``, one folder per shard, each folder written by one task."""
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    rows = stored(docs.select(doc, _text_bytes("text").alias("bytes"), _code("doc_id", "text", "doc_id").alias("code"), F.monotonically_increasing_id().alias("row")), "shard-rows")
    assigned = _assigned(rows.select("row", "bytes", "code"), "row", limit).select("row", F.col("shard").alias("in_shard"))
    placed = rows.join(assigned, "row").select("doc.*", "in_shard")
    placed.repartition("in_shard").write.partitionBy("in_shard").parquet(path)


def sharding_sql(limit: int = SHARD_BYTES) -> str:
    """The same shards in SQL, for keys that differ in their first 32 bits and rows within the limit."""
    return f"""
WITH rows AS (SELECT doc_id, coalesce(strlen(text), 0) AS bytes, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS code FROM documents),
level AS (SELECT unnest(range(0, 33)) AS depth),
bucket AS (SELECT depth, code >> (32 - depth) AS prefix, sum(bytes)::BIGINT AS shard_bytes, count(*) AS shard_docs
           FROM rows, level GROUP BY ALL HAVING sum(bytes) <= {limit}),
leaf AS (SELECT doc_id, bytes, code, min(depth) AS depth FROM rows JOIN bucket ON code >> (32 - depth) = prefix GROUP BY ALL)
SELECT doc_id, bytes, CASE WHEN depth > 0 THEN lpad(bin(prefix), depth::INT, '0') ELSE '' END AS shard, depth, shard_bytes, shard_docs
FROM leaf JOIN bucket USING (depth) WHERE code >> (32 - depth) = prefix
"""
