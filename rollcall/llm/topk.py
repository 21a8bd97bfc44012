"""Exact top-k search by distributed histogram selection.

Vectors become whole numbers, so scores are whole numbers and ties are exact. For each query the k-th best score lies in an interval,
at first the one the vectors' lengths allow. A round scores everything, counts scores by bins of the interval, adds the counts over
all tasks, and keeps the bin that holds the k-th score; the interval shrinks by the number of bins per round until
it is one value. A last pass keeps scores above that value, and of those at it the smallest ids, and ranks them.

Vectors and queries meet in a grid: blocks of vectors times blocks of queries, one cell per group, so neither side is broadcast and
a task holds one block of each. A cell sends on the bins from the top down to its own k-th score, the lower ones cannot matter.

Defined results: vectors that are null, or hold null or non-finite components, and rows without an id take no part; of rows with
equal ids the least vector counts; vectors meet only vectors of their length; components beyond the range of a long stand at its
end, and scores beyond 2^62 - 1 at that; a query with fewer than k candidates gets them all; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rollcall.llm.common import stored

SCALE = 256
VECTOR_BLOCK = 8192
QUERY_BLOCK = 1024
BINS = 512
_BATCH = 2048
#: Scores further from 0 stand at this end; an interval between both ends is still a long.
_FAR = 2**62 - 1


def usable(vector: str) -> Column:
    """Whether a vector is there and all its components are finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.col(vector).isNotNull() & finite


def whole(vector: str, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """A list column of equal lengths as rows of a matrix."""
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles while these hold all partial sums, else in wider numbers."""
    most = float(np.abs(queries.astype(float)).max(initial=0)) * float(np.abs(vectors.astype(float)).max(initial=0)) * max(1, vectors.shape[1])
    if most < 2**53:
        return queries.astype(float) @ vectors.astype(float).T
    if most < 2**62:
        return queries @ vectors.T
    exact = queries.astype(object) @ vectors.astype(object).T
    return np.clip(exact, -_FAR, _FAR).astype(np.int64)


def _blocks(left: pa.Table, queries: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, scores, whether a vector is not the query itself) for batches of the vectors of a cell."""
    q, v = matrix(queries["v"]), matrix(left["v"])
    ids, own = left["vec_id"].to_numpy(), queries["query_id"].to_numpy()
    for low in range(0, len(ids), _BATCH):
        part = ids[low : low + _BATCH]
        yield part, _scores(q, v[low : low + _BATCH]), part[None, :] != own[:, None]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = SCALE, bins: int = BINS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of ``vectors`` (vec_id, embedding) for each of ``queries``, itself left out."""
    ready = lambda df: df.where("vec_id IS NOT NULL").where(usable("embedding")).select(F.col("vec_id").cast("long").alias("vec_id"), whole("embedding", scale).alias("v")).groupBy("vec_id").agg(F.min("v").alias("v"))
    pool, asked = stored(ready(vectors), "topk-vectors"), stored(ready(queries), "topk-queries")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    n, longest = pool.agg(F.count(F.lit(1)), F.max(norm)).first()
    rows, columns = max(1, math.ceil(n / VECTOR_BLOCK)), max(1, math.ceil(asked.count() / QUERY_BLOCK))
    grid = pool.select("vec_id", "v", F.size("v").alias("dim"), F.pmod(F.xxhash64("vec_id"), F.lit(rows)).cast("int").alias("r"), F.explode(F.expr(f"sequence(0, {columns - 1})")).alias("c"))
    bound = norm * F.lit(longest or 0.0) + 1
    reach = F.when(bound < float(2**61), F.ceil(bound)).otherwise(F.lit(_FAR))
    state = stored(
        asked.select(F.col("vec_id").alias("query_id"), "v", F.size("v").alias("dim"), F.pmod(F.xxhash64("vec_id"), F.lit(columns)).cast("int").alias("c"), (-reach).alias("low"), reach.alias("high"), F.lit(k).cast("long").alias("need")),
        "topk-state",
    )
    # Both sides of the grid have these columns as int: equal numbers of other types hash to other tasks.
    cell = ["dim", "r", "c"]

    def met(function: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
        spread = state.withColumn("r", F.explode(F.expr(f"sequence(0, {rows - 1})")))
        return grid.groupBy(*cell).cogroup(spread.groupBy(*cell)).applyInArrow(function, schema)

    def counted(left: pa.Table, right: pa.Table) -> pa.Table:
        low, high, need = (right[c].to_numpy() for c in ("low", "high", "need"))
        width = (high - low) // bins + 1
        counts = np.zeros((len(low), bins), np.int64)
        if len(left) and len(right):
            for _, scores, other in _blocks(left, right):
                inside = other & (scores >= low[:, None]) & (scores <= high[:, None])
                at, _ = np.nonzero(inside)
                bin_of = (scores[inside].astype(np.int64) - low[at]) // width[at]
                counts += np.bincount(at * bins + bin_of, minlength=counts.size).reshape(counts.shape)
        above = counts[:, ::-1].cumsum(axis=1)[:, ::-1] - counts
        at, bin_of = np.nonzero((counts > 0) & (above < need[:, None]))
        return pa.table({"query_id": right["query_id"].to_numpy()[at], "bin": bin_of.astype(np.int64), "n": counts[at, bin_of]})

    while (state.agg(F.max(F.col("high") - F.col("low"))).first()[0] or 0) > 0:
        sums = met(counted, "query_id long, bin long, n long").groupBy("query_id", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("query_id").orderBy(F.col("bin").desc())
        reached = sums.withColumn("upto", F.sum("n").over(down)).join(state.select("query_id", "need"), "query_id").where("upto >= need")
        hit = reached.groupBy("query_id").agg(F.max_by(F.struct("bin", F.expr("upto - n AS over")), "bin").alias("hit"))
        width = F.expr(f"(high - low) div {bins} + 1")
        low = F.when(F.col("hit").isNotNull(), F.col("low") + F.col("hit.bin") * width).otherwise(F.col("low"))
        high = F.when(F.col("hit").isNotNull(), F.least("high", F.col("low") + (F.col("hit.bin") + 1) * width - 1)).otherwise(F.col("low"))
        state = stored(
            state.join(hit, "query_id", "left").select("query_id", "v", "dim", "c", low.alias("low"), high.alias("high"), (F.col("need") - F.coalesce("hit.over", F.lit(0))).alias("need")),
            "topk-state",
        )

    def kept(left: pa.Table, right: pa.Table) -> pa.Table:
        kth, own = right["low"].to_numpy(), right["query_id"].to_numpy()
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        ties: list[tuple[np.ndarray, np.ndarray]] = []
        if len(left) and len(right):
            for ids, scores, other in _blocks(left.sort_by("vec_id"), right):
                at, j = np.nonzero(other & (scores > kth[:, None]))
                found.append((own[at], ids[j], scores[at, j].astype(np.int64)))
                equal = other & (scores == kth[:, None])
                at, j = np.nonzero(equal & (equal.cumsum(axis=1) <= k))
                ties.append((at, ids[j]))
        if ties:
            at, ids = (np.concatenate(x) for x in zip(*ties, strict=True))
            order = np.lexsort((ids, at))
            at, ids = at[order], ids[order]
            place = np.arange(len(at)) - np.searchsorted(at, at)
            found.append((own[at[place < k]], ids[place < k], kth[at[place < k]]))
        columns = [np.concatenate(x).astype(np.int64) for x in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 3
        return pa.table(dict(zip(("query_id", "vec_id", "score"), columns, strict=True)))

    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    candidates = met(kept, "query_id long, vec_id long, score long")
    return candidates.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def topk_sql(every: int = 50, k: int = 5, scale: int = SCALE) -> str:
    """The same search in SQL, for unique ids."""
    return f"""
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % {every} = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= {k}
"""
