"""Benchmark decontamination by a prefix-filtered set join, in DataFrame functions only.

A benchmark item is cut into windows of ``WINDOW`` words (a shorter item is one window), a window into shingles of three words (one
or two, if it has no more). A window occurs in a document where all its shingles stand in a row, so of its shingles only one
has to be looked for: containment of everything needs a prefix of one token. The prefix is the rarest shingle by occurrences in
the documents, so windows that hold a shingle no document has are out at once, and a shingle that everybody uses is
joined only if nothing in the window is rarer.

1. Documents are read once. Each shingle is hashed, and only those whose bit is set among the bits of the benchmark's
   shingles (``FILTER_BITS``, whatever the size of the benchmark) leave the row, with their position and words.
2. Their occurrences give the order by rarity; the prefix of each window with its offset is joined to them. A join gives places where
   a window may start (position less offset), at most one for each offset and length, bounded by the document's two ends.
3. The document's own shingles from each such place on are put in order and joined, as words, to the windows. So a place has at most
   one window of each length, however many windows share a shingle, and what is equal is equal word by word.

Hot shingles are salted on both sides of the join by document.

Defined results: null and empty texts have no words, are hit by nothing and hit nothing; items of equal ids are one item; a null item id counts as
empty text; rows of equal ids each get a row; long texts are read whole; an empty table of documents gives no rows, an empty benchmark no
hits. Only ``doc_id``, ``text`` and ``item_id``, ``text`` are read, so further columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rollcall.llm.common import stored

WINDOW = 10
SHINGLE = 3
#: Bits that say which hashes of shingles the benchmark may have: 128 KiB, a constant of the plan.
FILTER_BITS = 1 << 20
SALTS = 16
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: str | Column) -> Column:
    """Words with A-Z lower-cased. Text of ASCII alone takes Spark's short way to lower case."""
    given = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    ascii_only = F.octet_length(given) == F.char_length(given)
    return F.regexp_extract_all(F.when(ascii_only, F.lower(given)).otherwise(F.translate(given, UPPER, LOWER)), F.lit(WORD_PATTERN), F.lit(0))


def _hash(words: Column, at: Column, length: int) -> Column:
    return F.xxhash64(*[F.get(words, at + k) for k in range(length)])


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item, m, words, length): each distinct window of m words of each item, and the length of its shingles."""
    worded = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words_of("text").alias("all")).where("size(all) > 0")
    starts = F.sequence(F.lit(0), F.greatest(F.size("all") - window, F.lit(0)))
    cut = worded.select("item", F.least(F.size("all"), F.lit(window)).alias("m"), "all", F.explode(starts).alias("start"))
    cut = cut.select("item", "m", F.slice("all", F.col("start") + 1, F.col("m")).alias("words")).distinct()
    return cut.withColumn("length", F.least("m", F.lit(SHINGLE)))


def _shingles(windows: DataFrame) -> DataFrame:
    """(m, length, signature, offset, shingle, h): the shingles of each distinct window. The signature is all of them in order."""
    at = F.sequence(F.lit(0), F.col("m") - F.col("length"))
    text = F.transform(at, lambda i: F.array_join(F.slice("words", i + 1, F.col("length")), " "))
    made = windows.select("m", "length", "words").distinct().select("m", "length", "words", text.alias("all"))
    made = made.select("m", "length", F.array_join("all", "\n").alias("signature"), "words", F.posexplode("all").alias("offset", "shingle"))
    h = F.when(F.col("length") == 1, _hash(F.col("words"), F.col("offset"), 1)).when(F.col("length") == 2, _hash(F.col("words"), F.col("offset"), 2)).otherwise(_hash(F.col("words"), F.col("offset"), 3))
    return made.select("m", "length", "signature", "offset", "shingle", h.alias("h"))


def _filter_bits(shingles: DataFrame, bits: int) -> Column:
    """The bits of all shingles as a constant array of ``bits`` / 64 longs. Lambdas take no subqueries, so the driver reads it."""
    spark, cells = shingles.sparkSession, bits // 64
    place = F.pmod("h", F.lit(bits))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int"))
    filled = shingles.select(F.floor(place / 64).cast("long").alias("cell"), one.alias("bit")).groupBy("cell").agg(F.bit_or("bit").alias("word"))
    dense = spark.range(cells).join(filled, F.col("id") == F.col("cell"), "left").select("id", F.coalesce("word", F.lit(0).cast("long")).alias("word"))
    words = dense.agg(F.sort_array(F.collect_list(F.struct("id", "word"))).alias("all")).select(F.to_json("all.word")).first()[0]
    return F.from_json(F.lit(words), "array<bigint>")


def _found(words: Column, length: int, bits: Column, n_bits: int) -> Column:
    """(pos, length, shingle, n_words) of the shingles of ``words`` that the bits let through."""

    def marked(at: Column) -> Column:
        place = F.pmod(_hash(words, at, length), F.lit(n_bits))
        return F.getbit(F.get(bits, F.floor(place / 64).cast("int")), F.pmod(place, F.lit(64)).cast("int")) == 1

    def taken(at: Column) -> Column:
        return F.struct(at.alias("pos"), F.lit(length).alias("length"), F.array_join(F.slice(words, at + 1, length), " ").alias("shingle"), F.size(words).alias("n_words"))

    starts = F.when(F.size(words) >= length, F.sequence(F.lit(0), F.size(words) - length)).otherwise(F.array().cast("array<int>"))
    return F.transform(F.filter(starts, marked), taken)


def seen_shingles(docs: DataFrame, known: Column, lengths: list[int], bits: int = FILTER_BITS) -> DataFrame:
    """(row, doc_id, pos, length, shingle, n_words): one for each row of ``docs``, with null ``pos``, and one for each shingle the bits let through.

    Words stay inside the row: what is exploded are the shingles found.
    """
    worded = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", words_of("text").alias("words"))
    words = F.col("words")
    whole = F.struct(F.lit(None).cast("int").alias("pos"), F.lit(0).alias("length"), F.lit(None).cast("string").alias("shingle"), F.size(words).alias("n_words"))
    found = F.concat(F.array(whole), *[_found(words, length, known, bits) for length in lengths])
    return worded.select("row", "doc_id", F.inline(found))


def window_hits(seen: DataFrame, shingles: DataFrame) -> DataFrame:
    """(row, start, m, signature): the places of documents at which a window stands."""
    counted = seen.groupBy("length", "shingle").agg(F.count(F.lit(1)).alias("times"))
    rated = shingles.join(counted, ["length", "shingle"], "left")
    prefix = rated.groupBy("m", "length", "signature").agg(F.min(F.struct(F.coalesce("times", F.lit(0)).alias("times"), "shingle", "offset")).alias("least")).where("least.times > 0")
    offsets = prefix.select("m", "length", F.col("least.shingle").alias("shingle"), F.col("least.offset").alias("offset")).distinct()
    dealt = offsets.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    places = (
        seen.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"))
        .join(dealt, ["length", "shingle", "salt"])
        .withColumn("start", F.col("pos") - F.col("offset"))
        .where("start >= 0 AND start + m <= n_words")
        .select("row", "start", "m", "length")
        .distinct()
    )
    asked = places.select("row", "start", "m", "length", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("m") - F.col("length"))).alias("pos"))
    own = asked.join(seen.select("row", "pos", "length", "shingle"), ["row", "pos", "length"])
    whole = own.groupBy("row", "start", "m", "length").agg(F.sort_array(F.collect_list(F.struct("pos", "shingle"))).alias("all")).where("size(all) = m - length + 1")
    signed = whole.select("row", "start", "m", F.array_join("all.shingle", "\n").alias("signature"))
    return signed.join(shingles.select("m", "signature").distinct(), ["m", "signature"]).select("row", "start", "m", "signature")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, bits: int = FILTER_BITS) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, item_ids, contaminated), one row per row of ``docs``.

    ``n_hit`` is the number of words inside any window that occurs, ``item_ids`` the sorted ids, as text, of the items of those windows.
    """
    windows = stored(item_windows(items, window), "leak-windows")
    shingles = stored(_shingles(windows), "leak-shingles")
    lengths = sorted({SHINGLE} | {r["length"] for r in windows.select("length").distinct().collect()})
    marked = _filter_bits(shingles, bits)
    seen = stored(seen_shingles(docs, marked, lengths, bits), "leak-seen")
    hits = stored(window_hits(seen.where("pos IS NOT NULL"), shingles), "leak-hits")
    before = Window.partitionBy("row").orderBy("start", "m").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("m")
    reached = hits.select("row", "start", "m").withColumn("reached", F.greatest(F.coalesce(F.max(end).over(before), F.lit(0)), F.col("start")))
    covered = reached.groupBy("row").agg(F.sum(F.greatest(end - F.col("reached"), F.lit(0))).alias("n_hit"))
    signature = F.array_join(F.transform(F.sequence(F.lit(0), F.col("m") - F.col("length")), lambda i: F.array_join(F.slice("words", i + 1, F.col("length")), " ")), "\n")
    owners = windows.select("item", "m", signature.alias("signature"))
    listed = hits.select("row", "m", "signature").distinct().join(owners, ["m", "signature"]).groupBy("row").agg(F.sort_array(F.collect_set("item")).alias("item_ids"))
    marks = covered.join(listed, "row").withColumnRenamed("row", "of")
    rows = seen.where("pos IS NULL").select("row", "doc_id", F.col("n_words").cast("long").alias("n_words"))
    hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    return rows.join(marks, F.col("row") == F.col("of"), "left").select("doc_id", "n_words", hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"), ids.alias("item_ids"), (hit > 0).alias("contaminated"))


def decontaminated(docs: DataFrame, items: DataFrame, most: float = 0.0, **options) -> DataFrame:
    """The rows of ``docs``, with their own columns, of whose words at most the share ``most`` is inside windows of the benchmark."""
    rows = stored(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.monotonically_increasing_id().alias("place")), "leak-rows")
    marks = contamination(rows.select(F.col("place").alias("doc_id"), F.col("doc.text").alias("text")), items, **options)
    clean = marks.where(F.col("n_hit") <= F.lit(most) * F.col("n_words")).select(F.col("doc_id").alias("place"))
    return rows.join(clean, "place", "left_semi").select("doc.*")


def contamination_digest(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The marks of ``contamination`` with the SHA-256 of the item ids, comma-joined, in place of their list."""
    digest = F.sha2(F.array_join("item_ids", ","), 256)
    return contamination(docs, items, **options).select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


def contamination_sql(window: int = WINDOW) -> str:
    """Every window of every document against those of the items, in SQL."""
    words = lambda text: rf"regexp_extract_all(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), '{WORD_PATTERN}')"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {words("text")} AS w FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {words("text")} AS w FROM benchmark),
bw AS (SELECT item, least(len(w), {window}) AS m, unnest(range(0, greatest(len(w) - {window}, 0) + 1)) AS s, w FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item, m, array_to_string(w[s + 1:s + m], ' ') AS key FROM bw),
ms AS (SELECT DISTINCT m FROM win),
dw AS (SELECT row, m, unnest(range(0, len(w) - m + 1)) AS s, w FROM d, ms WHERE len(w) >= m),
hit AS (SELECT row, s, dw.m, item FROM dw JOIN win ON win.m = dw.m AND win.key = array_to_string(w[s + 1:s + dw.m], ' ')),
pos AS (SELECT row, count(DISTINCT p) AS n_hit FROM (SELECT row, unnest(range(s, s + m)) AS p FROM hit) GROUP BY row),
ids AS (SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT row, item FROM hit) GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (row) LEFT JOIN ids USING (row)
"""
