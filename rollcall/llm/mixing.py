"""Mixing of sources to target weights by Pareto order sampling, in DataFrame functions only.

Every document first gets the whole copies its source is certain of (target / size, rounded down). The rest
of the target is a sample: documents rank by random odds over inclusion odds, ``(u / (1 - u)) / (p / (1 - p))``, the
lowest ranks are taken until the next one would pass the target, and the gap left is closed by the
one document not taken whose size comes nearest to it. Where that ends more than ``NEAR`` off the target, as at a
document of very many words, the sample goes on instead: documents that exceed the gap are passed over, the lowest ranks
of the others are taken by the same sums, round by round until none fits, and one document closes what is left. That is the walk down the
ranks that takes whatever still fits.

No task sees a whole source. Ranks are cut into buckets, bucket sums give the bucket where the sample
ends, and only the documents of that bucket are put in order.

Defined results: a null text has size 0 and takes no words; a null source is a source of its own, the last one; a
source of no words has target 0; equal rows are told apart by their place in the stored input, so one of
two can be taken; a null id counts as empty text in the random number; an empty table gives an empty mix. Only
``doc_id``, ``text`` and ``source`` are read, so further columns may have any name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rollcall.llm.common import stored, uniform, words_in

WEIGHTS = (5, 2, 1)
CAP = 3
BUCKETS = 4096
#: A source that ends farther from its target than this share of it goes on down the ranks.
NEAR = 0.01


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size, target) from one row (source, source_size) for each source.

    The targets are ``min(cap * size, level * weight)`` for the one level at which they add up to all sizes. Sources
    in the order of the level at which they reach their cap show it: the first whose cap is not reached.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_cap = Window.orderBy("reached", "place")
    everything = Window.partitionBy()
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_cap.rowsBetween(0, Window.unboundedFollowing)
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1)
    limit = (F.col("source_size") * cap).cast("double")
    levels = (
        sizes.withColumn("place", F.row_number().over(by_name))
        .withColumns({"weight": turn, "limit": limit})
        .withColumn("reached", F.col("limit") / F.col("weight"))
        .withColumn("level", (F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(rest))
        .withColumn("level", F.min(F.when(F.col("level") <= F.col("reached"), F.struct("reached", "place", "level"))).over(everything)["level"])
    )
    return levels.select("source", "source_size", F.least("limit", F.col("level") * F.col("weight")).alias("target"))


def _sampled(drawn: DataFrame) -> DataFrame:
    """The rows of ``drawn`` with ``sampled``: those of the lowest ranks of a source, until the next would pass ``wanted``."""
    along = Window.partitionBy("of").orderBy("bucket")
    sums = (
        drawn.groupBy(F.col("source").alias("of"), "bucket")
        .agg(F.sum("size").alias("words"), F.first("wanted").alias("wanted"))
        .withColumn("upto", F.sum("words").over(along))
        .withColumn("before", F.col("upto") - F.col("words"))
    )
    # One row per source: the bucket the sample ends in, or none where all are taken. Written, so that Spark knows how small it is
    # and leaves the documents where they are.
    found = sums.where("upto > wanted").groupBy("of").agg(F.min(F.struct("bucket", "before")).alias("end"))
    ends = stored(found.select("of", F.col("end.bucket").alias("last"), F.col("end.before").alias("before")), "mix-ends")
    placed = drawn.join(ends, F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
    inside = Window.partitionBy("source").orderBy("q", "u", "doc_id", "size", "row")
    split = placed.where("bucket = last").withColumn("upto", F.col("before") + F.sum("size").over(inside))
    return stored(
        placed.where("last IS NULL OR bucket < last")
        .withColumn("sampled", F.lit(True))
        .unionByName(placed.where("bucket > last").withColumn("sampled", F.lit(False)))
        .unionByName(split.withColumn("sampled", F.col("upto") <= F.col("wanted")).drop("upto"))
        .select("row", "doc_id", "source", "size", "q", "u", "bucket", "wanted", "sampled"),
        "mix-chosen",
    )


def _gaps(chosen: DataFrame) -> DataFrame:
    """(of, gap): the words a source's sample leaves open."""
    return stored(
        chosen.groupBy(F.col("source").alias("of"))
        .agg((F.first("wanted") - F.sum(F.when(F.col("sampled"), F.col("size")).otherwise(0))).alias("gap"))
        .where("gap > 0"),
        "mix-gaps",
    )


def _closing(chosen: DataFrame, gaps: DataFrame) -> DataFrame:
    """(of, row, miss): the document not sampled whose size comes nearest to the gap of its source, where it helps."""
    return (
        chosen.where("NOT sampled")
        .join(gaps, F.col("source").eqNullSafe(F.col("of")))
        .withColumn("miss", F.abs(F.col("size") - F.col("gap")))
        .where("miss < gap")
        .groupBy("of")
        .agg(F.min(F.struct("miss", "q", "u", "doc_id", "row")).alias("best"))
        .select("of", F.col("best.row").alias("row"), F.col("best.miss").alias("miss"))
    )


def mix(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP, seed: str = "", buckets: int = BUCKETS, near: float = NEAR
) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken), one row per row of ``docs``; see the module."""
    base = stored(
        docs.select("doc_id", "source", words_in("text").alias("size"), uniform(F.col("doc_id"), seed).alias("u")).withColumn("row", F.monotonically_increasing_id()),
        "mix-sizes",
    )
    targets = source_targets(base.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = stored(
        targets.withColumn("ratio", ratio)
        .withColumns({"whole": F.floor("ratio"), "p": F.col("ratio") - F.floor("ratio")})
        .withColumn("wanted", F.col("target") - F.col("whole") * F.col("source_size")),
        "mix-targets",
    ).select(F.col("source").alias("of"), "source_size", "target", "whole", "p", "wanted")
    odds = (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")))
    ranked = stored(
        base.join(plan, F.col("source").eqNullSafe(F.col("of")))
        .drop("of", "source_size", "target")
        .withColumn("q", F.when(F.col("p") > 0, odds))
        .withColumn("bucket", F.floor(F.lit(buckets) * (F.col("q") / (1 + F.col("q"))))),
        "mix-ranks",
    )
    chosen = _sampled(ranked.where("p > 0"))
    simple = _closing(chosen, _gaps(chosen))
    # The sources a document at the end leaves far from their target go on down the ranks.
    far = stored(
        _gaps(chosen).join(simple.select(F.col("of").alias("closed"), "miss"), F.col("of").eqNullSafe(F.col("closed")), "left")
        .withColumn("miss", F.coalesce("miss", "gap"))
        .join(plan.select(F.col("of").alias("planned"), "target"), F.col("of").eqNullSafe(F.col("planned")))
        .where(F.col("miss") > near * F.col("target"))
        .select("of", "gap", "miss"),
        "mix-far",
    )
    taken = chosen.where("sampled").select("row")
    if far.isEmpty():
        taken = taken.union(simple.select("row"))
    else:
        rest = chosen.where("NOT sampled").drop("sampled")
        passed, gaps = rest.where("1 = 0").select("row", "source"), far.select("of", "gap")
        while True:
            fitting = rest.drop("wanted").join(gaps.withColumnRenamed("gap", "wanted"), F.col("source").eqNullSafe(F.col("of"))).where("size > 0 AND size <= wanted").drop("of")
            step = _sampled(fitting.join(passed.select("row"), "row", "left_anti"))
            if step.isEmpty():
                break
            passed = stored(passed.union(step.where("sampled").select("row", "source")), "mix-passed")
            left = step.groupBy(F.col("source").alias("at")).agg(F.sum(F.when(F.col("sampled"), F.col("size")).otherwise(0)).alias("more"))
            gaps = stored(gaps.join(left, F.col("of").eqNullSafe(F.col("at")), "left").select("of", (F.col("gap") - F.coalesce("more", F.lit(0))).alias("gap")), "mix-left")
        unused = rest.join(passed.select("row"), "row", "left_anti").withColumn("sampled", F.lit(False))
        last = _closing(unused, gaps)
        ends = gaps.join(last.select(F.col("of").alias("closed"), F.col("miss").alias("least")), F.col("of").eqNullSafe(F.col("closed")), "left").select("of", F.coalesce("least", "gap").alias("least"))
        better = ends.join(far.select(F.col("of").alias("farther"), "miss"), F.col("of").eqNullSafe(F.col("farther"))).where("least < miss")
        better = stored(better.select(F.col("of").alias("better")), "mix-better")
        walked = passed.select("row", F.col("source").alias("of")).union(last.select("row", "of"))
        same = F.col("of").eqNullSafe(F.col("better"))
        taken = taken.union(walked.join(better, same, "left_semi").select("row")).union(simple.join(better, same, "left_anti").select("row"))
    taken = taken.withColumn("extra", F.lit(1))
    copies = F.col("whole") + F.coalesce("extra", F.lit(0))
    return (
        base.join(taken, "row", "left")
        .join(plan, F.col("source").eqNullSafe(F.col("of")))
        .select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))
    )


def mixed_rows(docs: DataFrame, seed: str = "", **options) -> DataFrame:
    """The rows of ``docs`` as the mix takes them: each as often as it is taken, with its own columns.

    Within a source the sample is nearly all rows below one random number, so copies are decided where the text lies, by a
    row for each source. Only the ids on the wrong side of it (closing documents, those of a walk, rows that draw equal numbers across the end)
    are a table of their own, and only their texts are looked at again: rows of the same id, source and size draw the same number, and
    the first of them by text get the further copies.
    """
    mixed = stored(mix(docs, seed=seed, **options).withColumn("u", uniform(F.col("doc_id"), seed)), "mix-decided")
    # Rows that only have their source's whole copies start at ``cut``; below it each has one more.
    low = F.col("copies") == F.floor(F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    plan = mixed.groupBy(F.col("source").alias("of")).agg(F.min(F.when(low, F.col("u"))).alias("cut"), F.min("copies").alias("least"), F.max("copies").alias("most"))
    plan = stored(plan.withColumn("whole", F.when(F.col("cut").isNull(), F.col("most") - 1).otherwise(F.col("least"))).select("of", "cut", "whole"), "mix-cuts")
    above = mixed.join(plan, F.col("source").eqNullSafe(F.col("of"))).where("u >= cut AND copies > whole")
    odd = stored(above.groupBy(F.col("doc_id").alias("id"), "of", F.col("size").alias("words")).agg(F.count(F.lit(1)).alias("further")), "mix-odd")
    ids = odd.select("id", F.col("of").alias("at")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    own = F.col("doc.doc_id").eqNullSafe(F.col("id")) & F.col("doc.source").eqNullSafe(F.col("at"))
    planned = lambda df: df.join(plan, F.col("doc.source").eqNullSafe(F.col("of")))
    below = F.coalesce(uniform(F.col("doc.doc_id"), seed) < F.col("cut"), F.lit(True)).cast("int")
    plain = planned(rows.join(ids, own, "left_anti")).select("doc", (F.col("whole") + below).alias("times"))
    sized = planned(rows.join(ids, own, "left_semi")).withColumn("size", words_in("doc.text")).drop("of")
    same = F.col("doc.doc_id").eqNullSafe(F.col("id")) & F.col("doc.source").eqNullSafe(F.col("of")) & (F.col("size") == F.col("words"))
    matched = sized.join(odd, same, "left").withColumn("further", F.coalesce("further", F.lit(0)))
    first = Window.partitionBy("doc.doc_id", "doc.source", "size").orderBy("doc.text")
    across = matched.select("doc", (F.col("whole") + (F.row_number().over(first) <= F.col("further")).cast("int")).alias("times"))
    times = plain.unionByName(across).where("times > 0")
    return times.select("doc", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("turn")).select("doc.*")


def mixing_sql(weights: Sequence[int] = WEIGHTS, cap: int = CAP, near: float = NEAR) -> str:
    """The same mix in SQL, for unique ids."""
    turns = ", ".join(f"{w}::DOUBLE" for w in weights)
    return rf"""
WITH RECURSIVE base AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
    FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM base GROUP BY source),
placed AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM sizes),
weighed AS (SELECT *, ([{turns}])[(place - 1) % {len(weights)} + 1] AS weight, (source_size * {cap})::DOUBLE AS cap FROM placed),
reached AS (SELECT *, cap / weight AS reached FROM weighed),
levels AS (
    SELECT *, (sum(source_size) OVER ()::DOUBLE
               - coalesce(sum(cap) OVER (ORDER BY reached, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(weight) OVER (ORDER BY reached, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM reached),
target AS (
    SELECT source, source_size, least(cap, (SELECT arg_min(level, (reached, place)) FROM levels WHERE level <= reached) * weight) AS target
    FROM levels),
plan AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole,
           CASE WHEN source_size > 0 THEN target / source_size - floor(target / source_size) ELSE 0 END AS p
    FROM target),
ranked AS (
    SELECT doc_id, b.source, size, u, target - whole * source_size AS wanted, (u / (1 - u)) / (p / (1 - p)) AS q
    FROM base b JOIN plan t ON b.source IS NOT DISTINCT FROM t.source WHERE p > 0),
running AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY q, u, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto FROM ranked),
chosen AS (SELECT *, upto <= wanted AS sampled FROM running),
gap AS (
    SELECT source, any_value(wanted) - sum(CASE WHEN sampled THEN size ELSE 0 END) AS gap FROM chosen GROUP BY source HAVING gap > 0),
closing AS (
    SELECT g.source, arg_min(doc_id, (abs(size - gap), q, u, doc_id)) AS doc_id, min(abs(size - gap)) AS miss
    FROM chosen c JOIN gap g ON c.source IS NOT DISTINCT FROM g.source
    WHERE NOT sampled AND abs(size - gap) < gap GROUP BY g.source),
far AS (
    SELECT g.source, gap, coalesce(miss, gap) AS miss
    FROM gap g JOIN plan t ON g.source IS NOT DISTINCT FROM t.source LEFT JOIN closing c ON g.source IS NOT DISTINCT FROM c.source
    WHERE coalesce(miss, gap) > {near} * target),
rest AS (
    SELECT c.source, doc_id, size, q, u, row_number() OVER (PARTITION BY c.source ORDER BY q, u, doc_id, size) AS k
    FROM chosen c JOIN far f ON c.source IS NOT DISTINCT FROM f.source WHERE NOT sampled),
walk AS (
    SELECT source, 0::BIGINT AS k, gap, NULL::BIGINT AS doc_id, false AS took FROM far
    UNION ALL
    SELECT w.source, r.k, CASE WHEN size > 0 AND size <= gap THEN gap - size ELSE gap END, r.doc_id, size > 0 AND size <= gap
    FROM walk w JOIN rest r ON w.source IS NOT DISTINCT FROM r.source AND r.k = w.k + 1),
walked AS (SELECT source, min(gap) AS gap FROM walk GROUP BY source),
last AS (
    SELECT w.source, arg_min(doc_id, (abs(size - gap), q, u, doc_id)) AS doc_id, min(abs(size - gap)) AS miss
    FROM rest r JOIN walked w ON r.source IS NOT DISTINCT FROM w.source
    WHERE abs(size - gap) < gap AND doc_id NOT IN (SELECT doc_id FROM walk WHERE took) GROUP BY w.source),
better AS (
    SELECT f.source FROM far f JOIN walked w ON f.source IS NOT DISTINCT FROM w.source LEFT JOIN last l ON l.source IS NOT DISTINCT FROM f.source
    WHERE coalesce(l.miss, w.gap) < f.miss),
extra AS (
    SELECT doc_id FROM chosen WHERE sampled
    UNION ALL SELECT doc_id FROM walk w JOIN better b ON w.source IS NOT DISTINCT FROM b.source WHERE took
    UNION ALL SELECT doc_id FROM last l JOIN better b ON l.source IS NOT DISTINCT FROM b.source
    UNION ALL SELECT doc_id FROM closing c WHERE NOT EXISTS (SELECT 1 FROM better b WHERE b.source IS NOT DISTINCT FROM c.source))
SELECT b.doc_id, b.source, b.size, source_size, target, whole + (e.doc_id IS NOT NULL)::INT AS copies,
       (whole + (e.doc_id IS NOT NULL)::INT) * b.size AS taken
FROM base b JOIN plan t ON b.source IS NOT DISTINCT FROM t.source LEFT JOIN extra e ON e.doc_id = b.doc_id
"""
