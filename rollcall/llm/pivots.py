"""Embedding near-duplicates by a pivot-permutation index.

Reference points (pivots) are rows of a bounded sample that keep a distance from each other. A vector is described by its ``near``
nearest pivots in order. The inverted lists are kept by every ``shared`` of these pivots together: two vectors stand in a
common list exactly if they share that many of their nearest pivots. Each list is then verified: cosines are computed in
doubles and only pairs at or above the threshold are links, so a missed pair is one with fewer shared pivots.
At the least cosine of 0.9 over 95 of 100 pairs share two of their six nearest among 512 pivots, at 0.95 over 99 (measured on
64 dimensions; ``tests/llm`` holds the recall against brute force).

Equal vectors are one class with a count, so a common vector is one row of the index. Lists of one vector are dropped before vectors
travel. Small lists are dealt into parts of even size and verified there; a long list is cut into blocks that meet in pairs. A
pair in several lists counts in the lowest of them. Verification emits, for each class and part, the number of links
and one edge to the lowest class it hangs together with, never the pairs.

Defined results: vectors that are null, empty or zero, or hold null or non-finite components, link with nothing; vectors link with
vectors of their length only; rows of equal ids are separate rows, and their id is the component's where it is
the smallest; a null id is the component's only where there is no other; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import stored
from rollcall.llm.topk import matrix, usable
from rollcall.operators.linkage import connected_components

THRESHOLD = 0.9
PIVOTS = 512
#: Rows the pivots are chosen from: those with the lowest hashes.
SAMPLE_ROWS = 4096
NEAR = 6
SHARED = 2
APART = 0.7
BLOCK = 512
PART_ROWS = 20_000


def choose_pivots(sample: np.ndarray, pivots: int = PIVOTS, apart: float = APART) -> np.ndarray:
    """The first unit vectors of ``sample`` of which no two are closer than a cosine of ``apart``."""
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    free, chosen = np.ones(len(unit), bool), []
    for i in range(len(unit)):
        if free[i]:
            chosen.append(i)
            if len(chosen) == pivots:
                break
            free &= unit @ unit[i] < apart
    return unit[chosen]


def _direction(v: np.ndarray) -> np.ndarray:
    """Unit vectors, safe for very large and very small components."""
    v = v.astype(float)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _keys(order: np.ndarray, shared: int) -> np.ndarray:
    """For rows of ascending pivot numbers, a key for every choice of ``shared`` of them."""
    from itertools import combinations

    columns = []
    for choice in combinations(range(order.shape[1]), shared):
        key = np.zeros(len(order), np.int64)
        for c in choice:
            key = key * 65536 + order[:, c]
        columns.append(key)
    return np.stack(columns, axis=1)


def _lowest_common(a: np.ndarray, b: np.ndarray, shared: int) -> np.ndarray:
    """The lowest key two rows have in common: that of their lowest common pivots."""
    common = (a[:, :, None] == b[:, None, :]).any(axis=2)
    ranked = np.where(common, a, 1 << 20)
    ranked.sort(axis=1)
    key = np.zeros(len(a), np.int64)
    for c in range(shared):
        key = key * 65536 + ranked[:, c]
    return key


def _roots(n: int, a: np.ndarray, b: np.ndarray, names: np.ndarray) -> np.ndarray:
    """For each of n rows the lowest name it hangs together with by the links (a, b)."""
    root = names.copy()
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        if (root == before).all():
            return root


def _pairs_of_list(unit: np.ndarray, left: np.ndarray, right: np.ndarray | None, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Links among rows ``left``, or between ``left`` and ``right``."""
    cosine = unit[left] @ unit[left if right is None else right].T
    i, j = np.nonzero(np.triu(cosine >= threshold, 1) if right is None else cosine >= threshold)
    return left[i], (left if right is None else right)[j]


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, pivots: int = PIVOTS, near: int = NEAR, shared: int = SHARED, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding)."""
    rows = vectors.select("vec_id", "embedding").withColumn("row", F.monotonically_increasing_id())
    with_length = F.exists("embedding", lambda x: x.cast("double") != 0)
    base = stored(rows.withColumn("counts", F.coalesce(usable("embedding") & with_length, F.lit(False))), "pivot-rows")
    classes = stored(
        base.where("counts").groupBy("embedding").agg(F.min("row").alias("class"), F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("n")).withColumn("dim", F.size("embedding")),
        "pivot-classes",
    )
    sample = classes.select("dim", "embedding").orderBy(F.xxhash64("embedding"), "class").limit(SAMPLE_ROWS).toPandas()
    points = {int(d): choose_pivots(_direction(np.stack(part["embedding"].to_numpy())), pivots) for d, part in sample.groupby("dim")}

    def pivots_of(dim: int) -> np.ndarray:
        # Lengths too rare to be in the sample get fixed random pivots.
        if dim not in points:
            points[dim] = _direction(np.random.default_rng(dim).normal(size=(min(pivots, 64), dim)))
        return points[dim]

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            dims = table["dim"].to_numpy()
            for dim in np.unique(dims):
                part = table.filter(pa.array(dims == dim))
                given = pivots_of(int(dim))
                unit = _direction(matrix(part["embedding"]))
                m, s = min(near, len(given)), min(shared, near, len(given))
                order = np.argsort(-(unit @ given.T), axis=1, kind="stable")[:, :m]
                ascending = np.sort(order, axis=1)
                yield pa.RecordBatch.from_arrays(
                    [part["class"].combine_chunks(), part["n"].combine_chunks(), part["dim"].combine_chunks(), pa.array(list(order.astype(np.int32)), pa.list_(pa.int32())), pa.array(list(_keys(ascending, s)), pa.list_(pa.int64()))],
                    names=["class", "n", "dim", "nearest", "keys"],
                )

    index = stored(classes.select("class", "n", "dim", "embedding").mapInArrow(described, "class long, n long, dim int, nearest array<int>, keys array<long>"), "pivot-index")
    entries = index.select("class", "dim", F.explode("keys").alias("key"))
    lists = stored(entries.groupBy("dim", "key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "pivot-lists")
    short = lists.where(F.col("size") <= block).agg(F.sum("size")).first()[0] or 0
    parts = max(1, math.ceil(short / PART_ROWS))
    placed = entries.join(lists, ["dim", "key"])
    few = placed.where(F.col("size") <= block).select("class", "dim", "key", F.pmod(F.xxhash64("key"), F.lit(parts)).alias("part"), F.lit(-1).alias("b1"), F.lit(-1).alias("b2"), F.lit(0).alias("own"))
    blocks = F.ceil(F.col("size") / F.lit(block))
    many = (
        placed.where(F.col("size") > block)
        .withColumn("own", F.pmod(F.xxhash64("class"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int"))))
        .select("class", "dim", "key", F.col("key").alias("part"), F.least("own", "other").alias("b1"), F.greatest("own", "other").alias("b2"), "own")
    )
    full = classes.select(F.col("class").alias("id"), "embedding").join(index.select(F.col("class").alias("id"), "n", F.array_sort("nearest").alias("nearest")), "id")
    dealt = few.unionByName(many).join(full, F.col("class") == F.col("id")).select("part", "dim", "b1", "b2", "own", "key", "class", "n", "nearest", "embedding")

    def verified(group: pa.Table) -> pa.Table:
        unit = _direction(matrix(group["embedding"]))
        order = matrix(group["nearest"]).astype(np.int64)
        keys, own, names, n = (group[c].to_numpy() for c in ("key", "own", "class", "n"))
        b1, b2 = group["b1"][0].as_py(), group["b2"][0].as_py()
        found: list[tuple[np.ndarray, np.ndarray]] = []
        if b1 >= 0 and b1 != b2:
            found.append(_pairs_of_list(unit, np.flatnonzero(own == b1), np.flatnonzero(own == b2), threshold))
        else:
            by_key = np.lexsort((names, keys))
            cuts = np.flatnonzero(np.diff(keys[by_key])) + 1
            starts, stops = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(by_key)]])
            small = stops - starts <= 32
            for a, b in zip(starts[~small], stops[~small], strict=True):
                found.append(_pairs_of_list(unit, by_key[a:b], None, threshold))
            left = np.repeat(stops, stops - starts) * np.repeat(small, stops - starts)
            for step in range(1, 32):
                at = np.flatnonzero(np.arange(len(by_key)) + step < left)
                if not len(at):
                    break
                i, j = by_key[at], by_key[at + step]
                linked = np.einsum("ij,ij->i", unit[i], unit[j]) >= threshold
                found.append((i[linked], j[linked]))
        i, j = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, int), np.zeros(0, int))
        choose = min(shared, order.shape[1])
        first = np.concatenate([_lowest_common(order[i[k : k + 100_000]], order[j[k : k + 100_000]], choose) == keys[i[k : k + 100_000]] for k in range(0, len(i), 100_000)]) if len(i) else np.zeros(0, bool)
        i, j = i[first], j[first]
        links = np.bincount(i, weights=n[j], minlength=len(n)) + np.bincount(j, weights=n[i], minlength=len(n))
        root = _roots(len(n), i, j, names)
        hit = links > 0
        return pa.table({"class": names[hit], "links": links[hit].astype(np.int64), "root": root[hit]})

    found = stored(dealt.groupBy("part", "dim", "b1", "b2").applyInArrow(verified, "class long, links long, root long").groupBy("class", "root").agg(F.sum("links").alias("links")), "pivot-links")
    roots = connected_components(found.select(F.col("class").alias("hi"), F.col("root").alias("lo"))).df
    summed = found.groupBy(F.col("class").alias("id")).agg(F.sum("links").alias("links"))
    joined = (
        classes.select("class", "low", "n", "embedding")
        .join(summed, F.col("class") == F.col("id"), "left")
        .drop("id")
        .join(roots, F.col("class") == F.col("id"), "left")
        .select("class", "low", "embedding", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "class").alias("top"))
    )
    joined = stored(joined, "pivot-classes-linked")
    named = joined.join(joined.groupBy(F.col("top").alias("of")).agg(F.min("low").alias("component_id")), F.col("top") == F.col("of")).select(F.col("embedding").alias("vector"), "n_links", "component_id")
    linked = base.where("counts").join(named, F.col("embedding") == F.col("vector")).select("vec_id", "n_links", "component_id")
    single = base.where("NOT counts").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(single).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
