"""SimHash near-duplicates by covering locality-sensitive hashing.

A text's fingerprint has 64 bits by majority vote of the hashes of its word shingles. For a radius r, every bit position
gets a non-zero vector of r + 1 bits; table v (any of the 2^(r+1) - 1 non-zero vectors) compares the bits whose vector has
an odd product with v. Two fingerprints that differ in at most r positions agree in some table: r vectors of r + 1 bits
leave a v that is orthogonal to all of them (Pagh, "CoveringLSH", 2018). So candidates are an equi-join on (table, masked
fingerprint), and no linked pair is lost.

Copies count once: links are sought between distinct fingerprints. Buckets of few fingerprints are paired within one row. In
larger ones every fingerprint is put down at all points one bit away in the positions the table leaves free, and at
itself; fingerprints at a common point are within two bits of each other, and any two within two bits have one. A point
takes at most 65 fingerprints, so stars around the lowest one give the same components without a pair per bucket. For
a larger even radius r the points are those up to r / 2 bits away.

Components of the links come from contraction over written tables.

The pipeline's stage, ``without_near_copies``, goes by shingles of five words and a similarity of 0.8. Fingerprints of these shingles
within the radius, found by the same masks, are compared first, exactly. They cannot reach all such pairs: at 0.8 the expected distance is
near 10 of 64 bits (the angle of a cosine of 0.89), and masks that cover a radius of r number 2^(r + 1) - 1. So an exact prefix
filter then finds the pairs that are still apart; no pair is lost, and none is linked without its sets being compared.

Defined results: null and empty texts, and texts of white space, have fingerprint zero and are linked like any others; texts of
fewer words than a shingle hash as a whole; rows of equal ids each get a row; a null id is never the smallest one
unless its component has no other; an empty table gives no rows. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import operator
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rollcall.llm.common import stored, to_python
from rollcall.operators.linkage import connected_components
from rollcall.scratch import keep

SHINGLE = 3
RADIUS = 2
#: What the pipeline's stage calls near copies: shingles of five words, a Jaccard similarity of 0.8 and more.
STAGE_SHINGLE = 5
SIMILARITY = 0.8
#: Shingles that more sets hold come last in the filter's order.
COMMON = 16
#: Shingles below this hash, 30 % of all, come before others. A set's prefix is a fifth of it, so most prefixes lie among them.
LOW = 3 * (1 << 64) // 10
#: 64-bit words of a set's map, in which every shingle flips one bit. Where maps differ the sets do, so maps bound how similar sets can be.
MAP = 16
#: Rounds of one check a set, before common shingles are joined.
ROUNDS = 4
#: Centres drawn for a shingle in a round.
DRAWS = 8
#: Buckets up to this size are paired directly.
SMALL = 16
_BLOCK = 1 << 14


def _hashes(text: bytes | None, shingle: int) -> Iterator[np.ndarray]:
    """The hashes of a text's word shingles, repeats included, in blocks."""
    words = (text or b"").lower().split()
    if not words:
        return
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[: n - 1]]).tolist()
    stops = (ends[len(words) - n :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    for low in range(0, n, _BLOCK):
        yield np.array([digest(joined[a:b], 42) for a, b in zip(starts[low : low + _BLOCK], stops[low : low + _BLOCK])], np.uint64)


def _majority(blocks: Iterable[np.ndarray]) -> int:
    """The bits that are set in over half of the hashes."""
    ones, n = np.zeros(64, np.int64), 0
    for block in blocks:
        bits = np.unpackbits(block.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        n += len(block)
    return int(np.packbits((2 * ones > n).astype(np.uint8), bitorder="little").view("<u8")[0])


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of UTF-8 text. Bytes lower-case and split by the ASCII rules."""
    return _majority(_hashes(text, shingle))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, bits) with the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t, shingle) for t in batch.column(1).to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "bits"])

    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return to_python(rows).mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, bits long")


def covering_masks(radius: int = RADIUS) -> list[int]:
    """The bits each table compares. Position i has the vector i mod (2^(r+1) - 1) + 1."""
    vectors = (1 << (radius + 1)) - 1
    return [sum(1 << i for i in range(64) if bin((i % vectors + 1) & v).count("1") % 2) for v in range(1, vectors + 1)]


def _long(bits: int) -> int:
    return bits - (1 << 64) if bits >= 1 << 63 else bits


def _points(free: list[int], reach: int) -> list[int]:
    """All ways to flip up to ``reach`` of the free bits."""
    found = [0]
    level = [(0, -1)]
    for _ in range(reach):
        level = [(flips | 1 << b, k) for flips, last in level for k, b in enumerate(free) if k > last]
        found += [flips for flips, _ in level]
    return found


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS, small: int = SMALL) -> DataFrame:
    """(hi, lo): links between distinct fingerprints ``bits`` whose components are those of all pairs within the radius."""
    if radius % 2:
        raise ValueError("an even radius is needed")
    masks = covering_masks(radius)
    placed = distinct.select("bits", F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.col("bits").bitwiseAND(F.lit(_long(m))).alias("key")) for t, m in enumerate(masks)])).alias("p")).select("bits", "p.t", "p.key")
    crowds = placed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = stored(placed.join(crowds, ["t", "key"]), "simhash-buckets")
    listed = shared.where(F.col("n") <= small).groupBy("t", "key").agg(F.sort_array(F.collect_list("bits")).alias("all"))
    near = F.expr(f"filter(slice(all, i + 2, size(all)), y -> bit_count(y ^ all[i]) <= {radius})")
    pairs = (
        listed.select("all", F.explode(F.expr("sequence(0, size(all) - 2)")).alias("i"))
        .select(F.col("all")[F.col("i")].alias("lo"), F.explode(near).alias("hi"))
        .select("hi", "lo")
    )
    points: Column | None = None
    for t, m in enumerate(masks):
        flips = F.array(*[F.lit(_long(p)) for p in _points([b for b in range(64) if not m >> b & 1], radius // 2)])
        points = F.when(F.col("t") == t, flips) if points is None else points.when(F.col("t") == t, flips)
    met = (
        shared.where(F.col("n") > small)
        .select("t", "bits", F.explode(points).alias("flip"))
        .groupBy("t", F.col("bits").bitwiseXOR(F.col("flip")).alias("point"))
        .agg(F.sort_array(F.collect_list("bits")).alias("all"))
        .where("size(all) > 1")
    )
    stars = met.select(F.col("all")[0].alias("lo"), F.explode(F.expr("slice(all, 2, size(all))")).alias("hi")).select("hi", "lo")
    return pairs.unionByName(stars).distinct()


def simhash_components(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``."""
    marked = stored(fingerprints(docs, shingle), "simhash")
    distinct = stored(marked.groupBy("bits").agg(F.min("doc_id").alias("low")), "simhash-distinct")
    roots = connected_components(fingerprint_links(distinct, radius)).df
    grouped = distinct.join(roots.select(F.col("id").alias("bits"), "root"), "bits", "left").select("bits", "low", F.coalesce("root", "bits").alias("root"))
    lowest = grouped.groupBy("root").agg(F.min("low").alias("component_id"))
    named = grouped.join(lowest, "root").select(F.col("bits").alias("of"), "component_id")
    return marked.join(named, F.col("bits") == F.col("of")).select("doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id")


def _set(blocks: list[np.ndarray]) -> np.ndarray:
    return np.unique(np.concatenate(blocks)) if blocks else np.empty(0, np.uint64)


def shingle_set(text: bytes | None, shingle: int = STAGE_SHINGLE) -> np.ndarray:
    """The distinct hashes of a text's word shingles, sorted; words as in ``fingerprint``."""
    return _set(list(_hashes(text, shingle)))


def _map(found: np.ndarray) -> np.ndarray:
    odd = (np.bincount((found >> np.uint64(20)).astype(np.int64) % (64 * MAP), minlength=64 * MAP) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def _sketches(rows: DataFrame, shingle: int) -> DataFrame:
    """(row, code, size, bits, map, low): ``code`` is equal for equal sets of shingles, ``bits`` the fingerprint, ``low`` the set's hashes below ``LOW``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, sizes, prints, maps, lows = [], [], [], [], []
            for text in batch.column(1).to_pylist():
                blocks = list(_hashes(text, shingle))
                found = _set(blocks)
                codes.append(_long(xxhash.xxh64_intdigest(found.tobytes(), 1)))
                sizes.append(len(found))
                prints.append(_long(_majority(blocks)))
                maps.append(_map(found))
                lows.append(found[: np.searchsorted(found, np.uint64(LOW))].view(np.int64))
            columns = [pa.array(c, pa.int64()) for c in (codes, sizes, prints)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, pa.array(maps, pa.list_(pa.int64())), pa.array(lows, pa.list_(pa.int64()))], names=["row", "code", "size", "bits", "map", "low"])

    given = rows.select("row", F.col("text").cast("binary").alias("text"))
    return to_python(given).mapInArrow(run, "row long, code long, size long, bits long, map array<long>, low array<long>")


def _similar(pairs: DataFrame, texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """The (hi, lo) of ``pairs`` whose sets of shingles are at least that similar, exactly.

    The lower text travels once for each of up to 64 parts of its partners, so one text with many partners is no single task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, known = None, None
        for batch in batches:
            his, los = [], []
            for hi, lo, text, low_text in zip(*(batch.column(c).to_pylist() for c in ("hi", "lo", "text", "low_text")), strict=True):
                if lo != last:
                    last, known = lo, shingle_set(low_text, shingle)
                found = shingle_set(text, shingle)
                both = len(np.intersect1d(found, known, assume_unique=True))
                if 1000 * both >= round(1000 * similarity) * (len(found) + len(known) - both):
                    his.append(hi)
                    los.append(lo)
            yield pa.RecordBatch.from_arrays([pa.array(his, pa.int64()), pa.array(los, pa.int64())], names=["hi", "lo"])

    parted = pairs.withColumn("part", F.pmod(F.xxhash64("hi"), F.lit(64)))
    lows = parted.select("lo", "part").distinct().join(texts.select(F.col("node").alias("lo"), F.col("text").alias("low_text")), "lo")
    given = parted.join(texts.withColumnRenamed("node", "hi"), "hi").join(lows, ["lo", "part"]).select("hi", "lo", "text", "low_text")
    return stored(to_python(given).mapInArrow(run, "hi long, lo long"), "near-links")


def _prefix(size: Column, similarity: float) -> Column:
    """Of how many first shingles, in any order that all sets share, a set as similar as asked must hold one among its own first."""
    return size - F.ceil(size * F.lit(round(1000 * similarity)) / 1000) + 1


def _whole_sets(texts: DataFrame, shingle: int) -> DataFrame:
    """(node, h) for every shingle of (node, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = shingle_set(text, shingle).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), node, np.int64)), pa.array(found)], names=["node", "h"])

    return to_python(texts.select("node", "text")).mapInArrow(run, "node long, h long")


def _placed(sets: DataFrame, similarity: float) -> DataFrame:
    """(h, node, size, place, common) of whole sets (h, node, size, n): the prefix of each, without what no other set holds.

    The order is: rare shingles below ``LOW``, other rare ones, common ones.
    """
    common = F.col("n") > COMMON
    place = F.row_number().over(Window.partitionBy("node").orderBy(common, (F.col("h") < 0) | (F.col("h") >= LOW), "h"))
    return sets.withColumn("place", place.cast("long")).where((F.col("place") <= _prefix(F.col("size"), similarity)) & (F.col("n") > 1)).select("h", "node", "size", "place", common.alias("common"))


def _prefixes(nodes: DataFrame, rows: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """(h, node, size, place, common): for each of (node, size, low) its first shingles that other sets hold too.

    Rare shingles below ``LOW`` come first, so a set with enough of them needs no others. The other sets, short or made of common
    shingles, are ordered whole; only among these are shingles from ``LOW`` on counted, as they stand in no other prefix.
    """
    low = nodes.select("node", F.posexplode("low").alias("i", "h"))
    shared = stored(low.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("h"))).where("n > 1"), "near-shared")
    sizes = stored(nodes.select("node", "size", F.size("low").alias("m")), "near-sizes")
    common = (F.col("n") > COMMON).cast("long")
    counts = shared.groupBy("node").agg(F.sum(common).alias("gone"))
    needed = _prefix(F.col("size"), similarity)
    short = sizes.join(counts, "node", "left").where(F.col("m") - F.coalesce("gone", F.lit(0)) < needed)
    short = stored(short.select("node", "size"), "near-short")
    before = F.sum(common).over(Window.partitionBy("node").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    place = F.col("i") + 1 - F.col("before")
    rare = shared.join(short.select("node"), "node", "left_anti").withColumn("before", before).where(F.col("n") <= COMMON)
    rare = rare.join(sizes, "node").where(place <= needed).select("h", "node", "size", place.alias("place"), F.lit(False).alias("common"))
    texts = rows.join(short.select(F.col("node").alias("row")), "row", "left_semi").select(F.col("row").alias("node"), F.col("text").cast("binary").alias("text"))
    whole = stored(_whole_sets(texts, shingle), "near-whole").join(short, "node")
    upper = (F.col("h") < 0) | (F.col("h") >= LOW)
    of_upper = whole.where(upper).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("h")))
    of_low = whole.where(~upper).join(shared.select("node", "h", "n"), ["node", "h"], "left").withColumn("n", F.coalesce("n", F.lit(1)))
    sets = of_upper.select("h", "node", "size", "n").unionByName(of_low.select("h", "node", "size", "n"))
    return stored(rare.unionByName(_placed(sets, similarity)), "near-prefixes")


def _may_pair(similarity: float, other: str = "other") -> Column:
    """Whether a row and ``other``, in the first shingle they share, can be as similar as asked by their sizes and places (Xiao et al., WWW 2008)."""
    least = round(1000 * similarity)
    fits = F.least("size", f"{other}.size") * 1000 >= F.greatest("size", f"{other}.size") * least
    ahead = F.least(F.col("size") - F.col("place"), F.col(f"{other}.size") - F.col(f"{other}.place")) + 1
    return (F.col("root") != F.col(f"{other}.root")) & fits & (ahead * (1000 + least) >= (F.col("size") + F.col(f"{other}.size")) * least)


def _meeting(placed: DataFrame, similarity: float) -> DataFrame:
    """(node, other) of (h, node, size, place, root): sets of different components that share a shingle of their prefixes and may be similar.

    Of n shingles a set as similar as asked lacks at most n less ``similarity`` times n, so of its first ones of that number and one more one
    stands among the first of the other set too (prefix filtering, Chaudhuri et al., ICDE 2006). No pair is lost.
    """
    other = placed.select("h", F.struct("node", "size", "place", "root").alias("other"))
    return placed.join(other, "h").where(_may_pair(similarity) & (F.col("node") > F.col("other.node"))).select("node", F.col("other.node").alias("other")).distinct()


def _meeting_by_rare_shingles(nodes: DataFrame, texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """(node, other) of (node, size, root) with whole texts (node, text)."""
    sets = _whole_sets(texts, shingle).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("h"))).join(nodes, "node")
    placed = stored(_placed(sets.select("h", "node", "size", "n"), similarity), "near-rare").join(nodes.select("node", "root"), "node")
    return _meeting(placed, similarity)


def _unpacked(nodes: DataFrame) -> DataFrame:
    """(node, map) with the map as a row of ``MAP`` longs."""
    return nodes.select("node", F.struct(*[F.col("map")[i].alias(f"m{i}") for i in range(MAP)]).alias("map"))


def _differ(other: str) -> Column:
    """In how many bits the maps of a row and ``other`` differ."""
    bits = [F.bit_count(F.col(f"map.m{i}").bitwiseXOR(F.col(f"{other}.map.m{i}"))) for i in range(MAP)]
    return reduce(operator.add, bits)


def _centres(labels: DataFrame, nodes: DataFrame, turn: int, similarity: float) -> DataFrame:
    """(h, node, size, place, common, root, other): rows whose shingle several components hold, with the nearest by maps of ``DRAWS`` drawn holders
    that may pair, as (bits, node), or null."""
    wide = labels.join(_unpacked(nodes), "node")
    holder = F.struct("node", "size", "place", "root", "map")
    drawn = [F.min_by(holder, F.xxhash64("node", F.lit(turn * DRAWS + k))).alias(f"c{k}") for k in range(DRAWS)]
    several = wide.groupBy("h").agg(F.min("root").alias("low"), F.max("root").alias("high"), *drawn).where("low < high").drop("low", "high")
    found = [F.when(_may_pair(similarity, f"c{k}"), F.struct(_differ(f"c{k}").alias("bits"), F.col(f"c{k}.node").alias("node"))) for k in range(DRAWS)]
    return wide.join(several, "h").select(*labels.columns, F.least(*found).alias("other"))


def _meeting_in_crowds(placed: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """As ``_meeting``, for shingles that many sets hold: maps of (node, map) travel along, so a pair they tell apart gives no row, any other
    one row, in the first shingle of ``placed`` that both hold.
    """
    order = Window.partitionBy("node").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    wide = placed.withColumn("before", F.collect_list("h").over(order)).join(_unpacked(nodes), "node")
    other = wide.select("h", F.struct("node", "size", "place", "root", "before", "map").alias("other"))
    least = round(1000 * similarity)
    near = _differ("other") * (1000 + least) <= (F.col("size") + F.col("other.size")) * (1000 - least)
    first = ~F.arrays_overlap("before", "other.before")
    return wide.join(other, "h").where((F.col("node") > F.col("other.node")) & _may_pair(similarity) & near & first).select("node", F.col("other.node").alias("other"))


def _by_fingerprint(nodes: DataFrame) -> DataFrame:
    """(node, other): candidates by SimHash, sets of one fingerprint and sets whose fingerprints are within the radius, as stars."""
    prints = stored(nodes.groupBy("bits").agg(F.min("node").alias("first")), "near-prints")
    links = fingerprint_links(prints.select("bits")).join(prints.select(F.col("bits").alias("hi"), F.col("first").alias("node")), "hi").join(prints.select(F.col("bits").alias("lo"), F.col("first").alias("other")), "lo")
    equal = nodes.join(prints, "bits").where("node != first").select("node", F.col("first").alias("other"))
    return links.select("node", "other").unionByName(equal)


def _bounded(pairs: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """The (hi, lo) of ``pairs`` that the maps of (node, size, map) do not tell apart: sets differ in no fewer shingles than maps do in bits."""
    least = round(1000 * similarity)
    maps = nodes.select("node", F.struct("size", "map").alias("of"))
    both = pairs.join(maps.withColumnRenamed("node", "hi").withColumnRenamed("of", "high"), "hi").join(maps.withColumnRenamed("node", "lo").withColumnRenamed("of", "low"), "lo")
    differ = F.aggregate(F.zip_with("high.map", "low.map", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
    return both.where(differ * (1000 + least) <= (F.col("high.size") + F.col("low.size")) * (1000 - least)).select("hi", "lo")


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """(id, root) with the components of ``roots`` that ``links`` join. Only links between components are contracted, each as one of their roots."""
    of = lambda side: roots.select(F.col("id").alias(side), F.col("root").alias(f"{side}_root"))
    between = links.join(of("hi"), "hi", "left").join(of("lo"), "lo", "left").select(F.coalesce("hi_root", "hi").alias("hi"), F.coalesce("lo_root", "lo").alias("lo"))
    moved = connected_components(between).df
    to = moved.select(F.col("id").alias("root"), F.col("root").alias("to"))
    return stored(roots.join(to, "root", "left").select("id", F.coalesce("to", "root").alias("root")).unionByName(moved), "near-roots")


def near_copy_groups(rows: DataFrame, shingle: int = STAGE_SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """(row, root) for every row of (row, text): the components of all pairs at least that similar.

    Equal sets count once. Sets whose fingerprints are within the radius are compared first. Then those that share a shingle of their
    prefixes across components are: all of them where the shingle is rare, and where it is common, first in rounds, each set with the nearest by maps
    of the centres drawn for its shingles, and then all that are still apart and that maps of the sets do not tell apart. The join on a common
    shingle lists these pairs only; it still looks at every two sets of the shingle.
    """
    whole = keep(_sketches(rows, shingle), "near-sketches")
    sketches = stored(whole.df.select("row", "code"), "near-codes")
    named = stored(sketches.groupBy("code").agg(F.min("row").alias("node")), "near-nodes")
    nodes = whole.df.join(named.select(F.col("node").alias("row")), "row", "left_semi").withColumnRenamed("row", "node")
    prefixes = _prefixes(nodes.select("node", "size", "low"), rows, shingle, similarity)
    nodes = stored(nodes.select("node", "size", "bits", "map"), "near-maps")
    whole.drop()
    open_nodes = stored(prefixes.select("node").distinct(), "near-open")
    texts = rows.select(F.col("row").alias("node"), F.col("text").cast("binary").alias("text"))
    tried: DataFrame | None = None
    roots = stored(rows.sparkSession.createDataFrame([], "id long, root long"), "near-roots")

    def compared(met: DataFrame) -> bool:
        """Links the similar ones of these pairs; whether any of them is."""
        nonlocal tried, roots
        pairs = met.select(F.greatest("node", "other").alias("hi"), F.least("node", "other").alias("lo")).distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["hi", "lo"], "left_anti")
        pairs = stored(_bounded(pairs, nodes, similarity), "near-pairs")
        found = _similar(pairs, texts, shingle, similarity)
        tried = pairs if tried is None else tried.unionByName(pairs)
        if found.isEmpty():
            return False
        roots = _joined(roots, found)
        return True

    def labelled(placed: DataFrame) -> DataFrame:
        return placed.join(roots.select(F.col("id").alias("node"), "root"), "node", "left").withColumn("root", F.coalesce("root", "node"))

    # A set that shares no shingle of its prefix is similar to none.
    met = _by_fingerprint(nodes.select("node", "bits"))
    compared(met.join(open_nodes, "node", "left_semi").join(open_nodes.withColumnRenamed("node", "other"), "other", "left_semi"))
    compared(_meeting(labelled(prefixes.where("NOT common")), similarity))
    linked = True
    for turn in range(ROUNDS + 1):
        labels = labelled(prefixes.where("common"))
        unsettled = stored(_centres(labels, nodes, turn, similarity), "near-unsettled")
        if unsettled.isEmpty():
            break
        if turn < ROUNDS and linked:
            linked = compared(unsettled.where("other IS NOT NULL").groupBy("node").agg(F.min("other").alias("other")).select("node", F.col("other.node").alias("other")))
        else:
            compared(_meeting_in_crowds(unsettled.drop("other"), nodes, similarity))
            break
    grouped = named.join(roots.select(F.col("id").alias("node"), "root"), "node", "left").select("code", F.coalesce("root", "node").alias("root"))
    return sketches.select("row", "code").join(grouped, "code").select("row", "root")


def without_near_copies(docs: DataFrame, shingle: int = STAGE_SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """One row of each group of near copies, with its own columns: the one with the smallest id, of equal ids the smallest text.

    Last the place in the stored input decides. Null ids come after all others.
    """
    rows = stored(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.monotonically_increasing_id().alias("row")), "near-rows")
    groups = near_copy_groups(rows.select("row", F.col("doc.text").alias("text")), shingle, similarity)
    named = stored(groups.join(rows.select("row", F.col("doc.doc_id").alias("id")), "row"), "near-named")
    lowest = named.groupBy("root").agg(F.min("id").alias("low"))
    firsts = stored(named.join(lowest, "root").where(F.col("id").eqNullSafe(F.col("low"))).select("root", "row"), "near-firsts")
    counted = firsts.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("row"))
    several = firsts.join(counted.where("n > 1").select("root"), "root", "left_semi").join(rows, "row")
    least = several.groupBy("root").agg(F.min_by("row", F.struct("doc.text", F.to_json("doc"), "row")).alias("row"))
    kept = stored(counted.where("n = 1").select("row").union(least.select("row")), "near-kept")
    return rows.join(kept, "row", "left_semi").select("doc.*")
