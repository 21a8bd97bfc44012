"""Listings with similar names, found without comparing all names of a block.

Names are compared as distinct token-sorted texts, taken apart into pairs of neighbouring letters. A deletion spoils at most
two such pairs and an insertion one, so two texts as alike as asked have most pairs in common, and then one of
the rarest pairs of each is a rare one of the other: as many of the rarest, and one more, as edits could spoil (prefix
filtering, Chaudhuri et al., ICDE 2006). Texts meet in an equi-join on (scope, block, lengths, letter pair). What nearly all names
of a block share is never a join key unless the rest of a name is shorter than the edits allowed. The filter
loses no pair. The names of a join key are joined in chunks, so a joined row stands for thousands of pairs. These are checked in Arrow batches,
all pairs of some rows in one step each: by letter counts in machine words, then by their distance, with the places of the shorter name in
the bits of one word and without the letters that all names of a row share at their ends.

Two names that have several rare pairs in common meet in each, and count in the rarest: every name carries its rarer pairs.
So pairs are listed as they are found, without a shuffle of what is found, and only the rows that meet are ever on disk.

``name_groups`` gives the groups that similar names form without listing their pairs. Names that meet in a key are compared with
one of them, links are contracted, and a key whose names are in one group by then is done with. Where that
finds nothing more, or no more pairs are left than there are names, names of different groups that still meet are compared, so the groups are those of all pairs. Only hashes of keys and
ids are shuffled and kept from round to round; texts are fetched for what is compared. A hash that two keys share costs a comparison and
links nothing, as scope and block are compared as well. No table of a round goes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.functions.binding import let, rows_with
from rollcall.functions.similarity import first_letter_block, least_distance, letter_bits, sorted_tokens
from rollcall.operators.linkage import SCOPE, connected_components
from rollcall.scratch import keep
from rollcall.settings import NAME_SIMILARITY


def distinct_names(listings: DataFrame, scope: tuple[str, ...] = SCOPE, block: str = "first") -> DataFrame:
    """(scope, block, text, id): each token-sorted name of a block once, under its lowest listing id.

    ``block="sorted"`` blocks by the first letter of the sorted words, so that names
    whose words stand in another order meet as well.
    """
    text = sorted_tokens(F.col("name"))
    letter = first_letter_block(text if block == "sorted" else F.col("name"))
    named = listings.select(*scope, letter.alias("block"), text.alias("text"), "id").where("block is not null")
    return named.groupBy(*scope, "block", "text").agg(F.min("id").alias("id"))


def same_name_edges(listings: DataFrame, scope: tuple[str, ...] = SCOPE, block: str = "first") -> DataFrame:
    """(hi, lo) from every listing to the lowest one with the same token-sorted name."""
    text = sorted_tokens(F.col("name"))
    letter = first_letter_block(text if block == "sorted" else F.col("name"))
    named = listings.select(*scope, letter.alias("block"), text.alias("text"), "id").where("block is not null")
    lowest = named.groupBy(*scope, "block", "text").agg(F.min("id").alias("lo"))
    return named.join(lowest.hint("merge"), [*scope, "block", "text"]).where("id > lo").select(F.col("id").alias("hi"), "lo")


def _edits(total: Column, threshold: int) -> Column:
    return F.floor(total * (100 - threshold) / 100).cast("int")


def _marked_pairs(text: Column) -> Column:
    """Pairs of neighbouring letters with their running number among equal ones, each as one long; the first letter has a mark before it."""
    marked = F.concat(F.lit("^"), text)
    letter = lambda i: F.ascii(F.substring(marked, i, F.lit(1))).cast("long")
    pairs = F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.call_function("shiftleft", letter(i), F.lit(42)) + F.call_function("shiftleft", letter(i + 1), F.lit(21)))

    def numbered(all_pairs: Column) -> Column:
        return F.transform(all_pairs, lambda g, i: g + F.size(F.filter(F.slice(all_pairs, F.lit(1), i), lambda x: x == g)))

    return let(pairs, numbered)


def _tasks(spark: SparkSession) -> int:
    """Tasks for rows that are few bytes and much work; left to their size they would fill one task."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)


def _rare_pairs(names: DataFrame, keys: list[str], threshold: int) -> DataFrame:
    """(keys, long, short, pair, rarer, text, id): the join keys of a name for every length a similar name of its block has.

    ``rarer`` are the name's join keys of these lengths before this one, in the order all names of the block have them in.
    """
    size = F.length("text")
    spread = names.repartition(_tasks(names.sparkSession), "id")
    pairs = spread.select(*keys, "text", "id", F.explode(_marked_pairs(F.col("text"))).alias("pair"))
    counts = pairs.groupBy(*keys, "pair").agg(F.count(F.lit(1)).alias("n"))
    ranked = (
        pairs.join(counts.hint("merge"), [*keys, "pair"])
        .groupBy(*keys, "text", "id")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "pair"))), lambda e: e["pair"]).alias("ranked"))
    )
    lengths = names.select(*keys, size.alias("other")).distinct()
    allowed = _edits(size + F.col("other"), threshold)
    deleted = F.floor((allowed + size - F.col("other")) / 2).cast("int")
    inserted = F.floor((allowed - size + F.col("other")) / 2).cast("int")
    spoilt = 2 * deleted + inserted
    each = ranked.join(lengths.hint("merge"), keys).where(F.abs(size - F.col("other")) <= allowed).withColumn("rare", F.slice("ranked", F.lit(1), F.greatest(spoilt + 1, F.lit(0))))
    met = each.select(*keys, F.greatest(size, "other").alias("long"), F.least(size, "other").alias("short"), "rare", F.posexplode("rare").alias("place", "pair"), "text", "id")
    return met.withColumn("rarer", F.slice("rare", F.lit(1), F.col("place"))).drop("rare", "place")


#: Names that are joined in one row, and how many rows of the longer names of a key one task has at a time.
_CHUNK, _TOGETHER = 128, 16


def _met_chunks(rare: DataFrame, scope: tuple[str, ...], keys: list[str]) -> DataFrame:
    """(scope, same, names_a, names_b): chunks (id, text, rarer) of the names of each join key, those that may be the longer one of a pair first.

    ``same`` is whether both have one length, so that each name stands on both sides. A key with many names is dealt over several tasks.
    """
    is_long, is_short = F.length("text") == F.col("long"), F.length("text") == F.col("short")
    sizes = rare.groupBy(*keys).agg(F.count_if(is_long).alias("n_a"), F.count_if(is_short).alias("n_b"))
    met = sizes.where("n_a > 0 AND n_b > 0 AND (long > short OR n_a > 1)")
    sides = F.array_compact(F.array(F.when(is_long, F.lit("a")), F.when(is_short, F.lit("b"))))
    sided = rare.join(met.hint("merge"), keys).withColumn("side", F.explode(sides))
    pieces = lambda n: F.ceil(n / _CHUNK)
    chunk = F.pmod(F.xxhash64("id"), pieces(F.when(F.col("side") == "a", F.col("n_a")).otherwise(F.col("n_b"))))
    named = F.collect_list(F.struct("id", "text", "rarer")).alias("names")
    cut = sided.groupBy(*keys, "side", chunk.alias("chunk")).agg(named, F.ceil(pieces(F.first("n_a")) / _TOGETHER).alias("parts"))
    chunks = keep(cut, "name-chunks").df
    longer = chunks.where("side = 'a'").select(*keys, F.call_function("div", "chunk", F.lit(_TOGETHER)).alias("part"), F.col("names").alias("names_a"))
    shorter = chunks.where("side = 'b'").select(*keys, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("names").alias("names_b"))
    join_keys = [*keys, "part"]
    longer, shorter = (side.repartition(_tasks(rare.sparkSession), *join_keys) for side in (longer, shorter))
    return longer.join(shorter.hint("merge"), join_keys).select(*scope, (F.col("long") == F.col("short")).alias("same"), "names_a", "names_b")


def _checked_threshold(threshold: int) -> int:
    if not 67 <= threshold <= 100:
        raise ValueError("threshold must be at least 67, or alike names need have no letter pair in common, and at most 100")
    return threshold


def candidate_pairs(listings: DataFrame, threshold: int, scope: tuple[str, ...] = SCOPE, block: str = "first") -> DataFrame:
    """(scope, lo, hi, text_lo, text_hi, distance): the pairs of names whose distance is measured, each once, with that distance."""
    return _compared(_met(listings, threshold, scope, block), threshold, scope, every=True)


def _met(listings: DataFrame, threshold: int, scope: tuple[str, ...], block: str) -> DataFrame:
    keys = [*scope, "block"]
    names = distinct_names(listings, scope, block)
    rare = keep(_rare_pairs(names, keys, _checked_threshold(threshold)), "rare-pairs").df
    return _met_chunks(rare, scope, [*keys, "long", "short", "pair"])


def _allowed(threshold: int) -> Column:
    return _edits(F.length("text_a") + F.length("text_b"), threshold)


def _bounded_distance(threshold: int, exact: bool = True) -> Column:
    """The distance of text_a and text_b, null beyond what is allowed. Without ``exact`` it may be an upper bound that is allowed.

    Each substitution counts as a deletion and an insertion, so the Levenshtein distance bounds it from above, as letter counts
    do from below. -1 stands for a distance that has to be measured.
    """
    allowed, apart = _allowed(threshold), F.abs(F.length("text_a") - F.length("text_b"))
    least = F.greatest(least_distance("bits_a", "bits_b"), apart)

    def within(edits: Column) -> Column:
        most = 2 * edits - apart
        known = (least >= most) if exact else (most <= allowed)
        return F.when((edits < 0) | (least > allowed), None).when(known, F.when(most <= allowed, most)).otherwise(F.lit(-1))

    return let(F.call_function("levenshtein", F.col("text_a"), F.col("text_b"), allowed), within).cast("int")


#: Cells of a batch of pairs that are worked on at a time.
_CELLS = 1 << 18


def _letters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The code points of all texts in one array, where each text starts, and how long it is."""
    sizes = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    codes = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le"), "<i4")
    return codes, np.cumsum(sizes) - sizes, sizes


def _rows(codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, filler: int) -> np.ndarray:
    """One column for each text, filled up to the longest with what no text holds."""
    at = np.arange(sizes.max(initial=0))[:, None]
    inside = at < sizes
    return np.where(inside, codes[np.where(inside, starts + at, 0)], filler) if len(codes) else np.full(inside.shape, filler)


def indel_distances(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Letters to delete and insert to turn each text of ``left`` into that of ``right``.

    The rows of the table of longest common subsequences, for many pairs in one step.
    """
    a, a_starts, a_sizes = _letters(left)
    b, b_starts, b_sizes = _letters(right)
    common = np.zeros(len(a_sizes), np.int64)
    order = np.argsort(b_sizes, kind="stable")
    low = 0
    while low < len(order):
        high = len(order)
        while high - low > 1 and (high - low) * (b_sizes[order[high - 1]] + 1) > _CELLS:
            high = low + (high - low) // 2
        part = order[low:high]
        rows, columns = _rows(a, a_starts[part], a_sizes[part], -1), _rows(b, b_starts[part], b_sizes[part], -2)
        table = np.zeros((len(columns) + 1, len(part)), np.int16 if len(columns) < 1 << 15 else np.int32)
        for row in rows:
            np.maximum.accumulate(np.maximum(table[1:], table[:-1] + (columns == row)), axis=0, out=table[1:])
        common[part] = table[-1]
        low = high
    return a_sizes + b_sizes - 2 * common


def _measured(pairs: DataFrame, threshold: int) -> DataFrame:
    """Those of ``pairs`` (text_a, text_b, distance, ..) that are as alike as asked, with the distances that were -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            distance = table["distance"].to_numpy().copy()
            unknown = np.flatnonzero(distance < 0)
            left, right = (table[c].take(pa.array(unknown)).combine_chunks() for c in ("text_a", "text_b"))
            distance[unknown] = indel_distances(left, right)
            sizes = (pc.utf8_length(table["text_a"]).to_numpy() + pc.utf8_length(table["text_b"]).to_numpy()).astype(np.int64)
            table = table.set_column(table.column_names.index("distance"), "distance", pa.array(distance, pa.int32()))
            yield from table.filter(pa.array(100 * distance <= (100 - threshold) * sizes)).combine_chunks().to_batches()

    return pairs.mapInArrow(run, T.StructType([T.StructField(f.name, f.dataType) for f in pairs.schema]))


#: Letters that the bits of one word have a place for.
_PLACES = 64
#: Pairs and names that are worked on at a time, unless one row has more.
_PAIRS, _NAMES = 1 << 17, 1 << 13


class _Names:
    """The names of one side of some joined rows: ids, texts, letters, what is counted of them, and the rarer pairs of each."""

    def __init__(self, lists: pa.ListArray):
        self.many = pc.list_value_length(lists).to_numpy().astype(np.int64)
        self.first = np.cumsum(self.many) - self.many
        ids, self.texts, rarer = lists.flatten().flatten()
        self.ids = ids.to_numpy()
        self.codes, self.starts, self.sizes = _letters(self.texts)
        self.n_rarer = pc.list_value_length(rarer).to_numpy().astype(np.int64)
        self.rarer = rarer.flatten().to_numpy()

    def of_rows(self, found: np.ufunc, values: np.ndarray) -> np.ndarray:
        return found.reduceat(values, self.first)

    def letter_words(self) -> list[np.ndarray]:
        """Words with a bit for each of the first letters of a cell, as ``letter_bits`` has it."""
        owner = np.repeat(np.arange(len(self.sizes)), self.sizes)
        counts = np.bincount(owner * 64 + self.codes % 64, minlength=64 * len(self.sizes)).reshape(-1, 64)
        return [np.packbits(counts > nth, axis=1).view(np.uint64)[:, 0] for nth in range(4)]

    def rarer_words(self, numbers: np.ndarray) -> list[np.ndarray]:
        """Four words with the bits of the ``numbers``, modulo 256, of a name's rarer pairs."""
        held = np.zeros((len(self.sizes), 256), bool)
        held[np.repeat(np.arange(len(self.sizes)), self.n_rarer), numbers % 256] = True
        return list(np.packbits(held, axis=1).view(np.uint64).T.copy())


def _shared(a: _Names, b: _Names, most: np.ndarray, at_end: bool) -> np.ndarray:
    """How many letters, up to ``most``, all names of a row have in common at their start or end."""
    shared, alike, k = np.zeros(len(most), np.int64), most > 0, 0
    while alike.any():
        letters = [x.codes[np.clip(x.starts + (x.sizes - 1 - k if at_end else k), 0, len(x.codes) - 1)] for x in (a, b)]
        low = np.minimum(a.of_rows(np.minimum, letters[0]), b.of_rows(np.minimum, letters[1]))
        high = np.maximum(a.of_rows(np.maximum, letters[0]), b.of_rows(np.maximum, letters[1]))
        alike &= low == high
        shared += alike
        k += 1
        alike &= most > k
    return shared


class _Inner:
    """Distances of names of joined rows: only what is between the letters that all names of a row share is compared."""

    def __init__(self, a: _Names, b: _Names):
        least = np.minimum(a.of_rows(np.minimum, a.sizes), b.of_rows(np.minimum, b.sizes))
        start = _shared(a, b, least, False)
        end = _shared(a, b, least - start, True)
        self.a, self.b = a, b
        (self.a_from, self.a_size), (self.b_from, self.b_size) = (
            (x.starts + np.repeat(start, x.many), x.sizes - np.repeat(start + end, x.many)) for x in (a, b)
        )
        known = np.zeros(max(x.codes.max(initial=0) for x in (a, b)) + 2, bool)
        for x in (a, b):
            known[x.codes] = True
        number = np.cumsum(known) - 1
        self.letters = int(known.sum()) + 1  # and one that no name has
        at = np.arange(self.a_size.max(initial=0))[:, None]
        inside = at < self.a_size
        self.columns = np.where(inside, number[a.codes[np.where(inside, self.a_from + at, 0)]], self.letters - 1)
        fits = np.where(self.b_size <= _PLACES, self.b_size, 0)
        owner = np.repeat(np.arange(len(fits)), fits)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(fits) - fits, fits)
        self.places = np.zeros(len(fits) * self.letters, np.uint64)
        np.add.at(self.places, owner * self.letters + number[b.codes[self.b_from[owner] + place]], np.left_shift(np.uint64(1), place.astype(np.uint64)))

    def distances(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Letters to delete and insert to turn name i of the one side into name j of the other.

        One word has the places of j's letters that no common subsequence ends at yet, and each letter of i is one step for all pairs.
        """
        distance = np.empty(len(i), np.int64)
        long = self.b_size[j] > _PLACES
        if long.any():
            distance[long] = indel_distances(self.a.texts.take(pa.array(i[long])), self.b.texts.take(pa.array(j[long])))
        short = np.flatnonzero(~long)
        short = short[np.argsort(-self.a_size[i[short]], kind="stable")]
        for low in range(0, len(short), 1 << 15):
            part = short[low : low + (1 << 15)]
            of_a, row = i[part], j[part] * self.letters
            size = self.a_size[of_a]
            steps = len(part) - np.searchsorted(size[::-1], np.arange(size[0]), side="right") if len(size) else ()
            unmet = np.full(len(part), ~np.uint64(0))
            for k, n in enumerate(steps):
                here = unmet[:n]
                hit = self.places[row[:n] + self.columns[k][of_a[:n]]] & here
                unmet[:n] = (here + hit) | (here - hit)
            common = np.bitwise_count(~unmet).astype(np.int64)
            distance[part] = size + self.b_size[j[part]] - 2 * common
        return distance


def _differ(a: list[np.ndarray], i: np.ndarray, b: list[np.ndarray], j: np.ndarray) -> np.ndarray:
    total = np.zeros(len(i), np.uint8)
    for x, y in zip(a, b, strict=True):
        total = total + np.bitwise_count(x[i] ^ y[j]).astype(np.int64)
    return total


def _first_met(a: _Names, i: np.ndarray, b: _Names, j: np.ndarray) -> np.ndarray:
    """Whether names i and j have no rarer pair in common than the one they meet in here."""
    distinct, numbers = np.unique(np.concatenate([a.rarer, b.rarer]), return_inverse=True)
    numbers_a, numbers_b = numbers[: len(a.rarer)], numbers[len(a.rarer) :]
    overlap = np.zeros(len(i), bool)
    for x, y in zip(a.rarer_words(numbers_a), b.rarer_words(numbers_b), strict=True):
        overlap |= (x[i] & y[j]) != 0
    if len(distinct) > 256:
        # Different pairs may share a bit, so what overlaps is looked up.
        perhaps = np.flatnonzero(overlap)
        really = np.zeros(len(perhaps), bool)
        matrix = lambda x, numbers, filler: _rows(numbers, np.cumsum(x.n_rarer) - x.n_rarer, x.n_rarer, filler)
        columns_b = [row[j[perhaps]] for row in matrix(b, numbers_b, -2)]
        for row in matrix(a, numbers_a, -1):
            of_a = row[i[perhaps]]
            for of_b in columns_b:
                really |= of_a == of_b
        overlap[perhaps] = really
    return ~overlap


def _similar(rows: pa.RecordBatch, threshold: int, every: bool) -> pa.RecordBatch:
    """The similar pairs of names that some joined rows stand for, or with ``every`` all that are measured."""
    n_scope = rows.num_columns - 3
    a, b = _Names(rows.column(n_scope + 1)), _Names(rows.column(n_scope + 2))
    same = rows.column(n_scope).to_numpy(zero_copy_only=False)
    counts = a.many * b.many
    row = np.repeat(np.arange(len(counts)), counts)
    within = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    of_a = within // b.many[row]
    i, j = a.first[row] + of_a, b.first[row] + within - of_a * b.many[row]
    once = np.flatnonzero(~same[row] | (a.ids[i] < b.ids[j]))
    row, i, j = row[once], i[once], j[once]
    limit = lambda: (100 - threshold) * (a.sizes[i] + b.sizes[j])
    near = np.flatnonzero(100 * _differ(a.letter_words(), i, b.letter_words(), j) <= limit())
    row, i, j = row[near], i[near], j[near]
    new = np.flatnonzero(_first_met(a, i, b, j))
    row, i, j = row[new], i[new], j[new]
    distance = _Inner(a, b).distances(i, j)
    if not every:
        alike = np.flatnonzero(100 * distance <= limit())
        row, i, j, distance = row[alike], i[alike], j[alike], distance[alike]
    texts = pa.concat_arrays([a.texts, b.texts])
    id_a, id_b, j = a.ids[i], b.ids[j], j + len(a.ids)
    first, last = np.where(id_a < id_b, i, j), np.where(id_a < id_b, j, i)
    columns = [rows.column(c).take(pa.array(row)) for c in range(n_scope)]
    columns += [pa.array(np.minimum(id_a, id_b)), pa.array(np.maximum(id_a, id_b)), texts.take(pa.array(first)), texts.take(pa.array(last)), pa.array(distance.astype(np.int32))]
    return pa.RecordBatch.from_arrays(columns, names=[*rows.schema.names[:n_scope], "lo", "hi", "text_lo", "text_hi", "distance"])


def _compared(met: DataFrame, threshold: int, scope: tuple[str, ...], every: bool = False) -> DataFrame:
    """(scope, lo, hi, text_lo, text_hi, distance) of the pairs in joined chunks of names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [pc.list_value_length(batch.column(len(scope) + c)).to_numpy().astype(np.int64) for c in (1, 2)]
            pairs, names = np.cumsum(sizes[0] * sizes[1]), np.cumsum(sizes[0] + sizes[1])
            low = 0
            while low < batch.num_rows:
                before = (pairs[low - 1], names[low - 1]) if low else (0, 0)
                fits = np.searchsorted(pairs, before[0] + _PAIRS, side="right"), np.searchsorted(names, before[1] + _NAMES, side="right")
                high = max(min(fits), low + 1)
                yield _similar(batch.slice(low, high - low), threshold, every)
                low = high

    found = [T.StructField("lo", T.LongType()), T.StructField("hi", T.LongType()), T.StructField("text_lo", T.StringType()), T.StructField("text_hi", T.StringType()), T.StructField("distance", T.IntegerType())]
    return met.mapInArrow(run, T.StructType([*[met.schema[c] for c in scope], *found]))


def similar_name_pairs(
    listings: DataFrame, threshold: int = NAME_SIMILARITY, scope: tuple[str, ...] = SCOPE, block: str = "first"
) -> DataFrame:
    """(scope, lo, hi, text_lo, text_hi, distance) of different names at least ``threshold`` percent alike.

    ``lo`` and ``hi`` are the lowest listing ids of the two names; together with
    ``same_name_edges`` they connect the same listings as all pairs would. The distance counts deletions and
    insertions, relative to the summed lengths.
    """
    return _compared(_met(listings, threshold, scope, block), threshold, scope)


def _linked(pairs: DataFrame, threshold: int) -> DataFrame:
    """(hi, lo): the groups, by their roots, that pairs of similar names put together."""
    near = pairs.select("text_a", "text_b", "root_a", "root_b", rows_with(_bounded_distance(threshold, exact=False)).alias("distance"))
    return _measured(near, threshold).select(F.greatest("root_a", "root_b").alias("hi"), F.least("root_a", "root_b").alias("lo")).distinct()


def _regrouped(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` (id, root) after links between roots."""
    moved = connected_components(links).df.select(F.col("id").alias("root"), F.col("root").alias("to")).hint("merge")
    return keep(roots.join(moved, "root", "left").select("id", F.coalesce("to", "root").alias("root")), "name-roots").df


def name_groups(
    listings: DataFrame, threshold: int = NAME_SIMILARITY, scope: tuple[str, ...] = SCOPE, block: str = "first"
) -> DataFrame:
    """(id, root) for every listing with a name: the lowest listing id that similar names connect it with, as all pairs would.

    A round compares each name with at most two others, so names that are all alike cost as many comparisons as there are names.
    """
    keys = [*scope, "block"]
    names = keep(distinct_names(listings, scope, block), "names").df
    rare = _rare_pairs(names, keys, _checked_threshold(threshold))
    is_long, is_short = F.length("text") == F.col("long"), F.length("text") == F.col("short")
    rare = keep(rare.select(F.xxhash64(*keys, "long", "short", "pair").alias("key"), is_long.alias("longer"), is_short.alias("shorter"), "id"), "rare-pairs").df
    known = keep(names.repartition(_tasks(names.sparkSession), "id").select(*keys, "id", "text", letter_bits(F.col("text")).alias("bits")), "name-bits").df

    def with_texts(pairs: DataFrame) -> DataFrame:
        """``pairs`` (id_a, root_a, id_b, root_b) of one scope and block, with texts and bits."""
        for x in "ab":
            pairs = pairs.join(known.select(*[F.col(c).alias(f"{c}_{x}") for c in known.columns]).hint("merge"), f"id_{x}")
        same = " AND ".join(f"{k}_a = {k}_b" for k in keys)
        return pairs.where(same)

    roots = keep(names.select("id", F.col("id").alias("root")), "name-roots").df
    count, turn = names.count(), 0
    while True:
        order = F.xxhash64("id", F.lit(turn))
        labelled = rare.join(roots.hint("merge"), "id").withColumns({"order": order, "one": F.struct("id", "root")})
        first = lambda side: F.expr(f"min_by(one, order) FILTER (WHERE {side})")
        several = labelled.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), first("longer").alias("a"), first("shorter").alias("b"))
        open_keys = several.where("low < high AND a IS NOT NULL AND b IS NOT NULL").select("key", "a", "b")
        unsettled = keep(labelled.join(open_keys.hint("merge"), "key").select("key", "longer", "shorter", "id", "root", "a", "b"), "name-open").df
        if unsettled.isEmpty():
            break
        # A key whose names are in one group stays so, and is not looked at again.
        rare = unsettled.select("key", "longer", "shorter", "id")
        as_pair = lambda a, b: [F.col(f"{x}.{c}").alias(f"{c}_{side}") for x, side in ((a, "a"), (b, "b")) for c in ("id", "root")]
        with_one = unsettled.withColumn("one", F.struct("id", "root"))
        longer = with_one.where(F.col("longer") & (F.col("root") != F.col("b.root")))
        shorter = with_one.where(F.col("shorter") & (F.col("root") != F.col("a.root")))
        one_each = lambda rows, other: rows.groupBy("id").agg(F.first("one").alias("one"), F.min_by(other, F.xxhash64("key", F.lit(turn))).alias("met"))
        pairs = one_each(longer, "b").select(*as_pair("one", "met")).unionByName(one_each(shorter, "a").select(*as_pair("met", "one")))
        sides_of = unsettled.groupBy("key").agg(F.count_if("longer").alias("longer"), F.count_if("shorter").alias("shorter"))
        few = sides_of.agg(F.sum(F.col("longer") * F.col("shorter"))).first()[0] <= count
        links = None if few else keep(_linked(with_texts(pairs), threshold), "name-links").df
        if links is None or links.isEmpty():
            sides = [with_one.where(side).select("key", F.col("one").alias(x)) for side, x in (("longer", "l"), ("shorter", "s"))]
            rest = sides[0].join(sides[1].hint("merge"), "key").where("l.root <> s.root").select(*as_pair("l", "s")).distinct()
            rest = with_texts(rest).where(least_distance("bits_a", "bits_b") <= _allowed(threshold))
            roots = _regrouped(roots, keep(_linked(rest, threshold), "name-links").df)
            break
        roots = _regrouped(roots, links)
        turn += 1
    again = same_name_edges(listings, scope, block).select(F.col("hi").alias("id"), "lo").join(roots.withColumnRenamed("id", "lo").hint("merge"), "lo")
    return roots.unionByName(again.select("id", "root"))


def name_edges(
    listings: DataFrame, threshold: int = NAME_SIMILARITY, scope: tuple[str, ...] = SCOPE, block: str = "first"
) -> DataFrame:
    """(hi, lo) edges that put listings with similar names into one group: one for each listing but the lowest."""
    return name_groups(listings, threshold, scope, block).where("id > root").select(F.col("id").alias("hi"), F.col("root").alias("lo"))
