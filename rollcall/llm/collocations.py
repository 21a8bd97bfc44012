"""Phrase collocations by an FM-index per shard over word ids.

1. Tasks cut the texts they read into shards of one language and of about ``SHARD_WORDS`` words: a file of word ids, with 0 between pieces, and the
   words of the shard with their counts. What tasks have left at their ends is put together to such a size. Counts add up to those of the language; words below ``min_count`` can be in no
   candidate, so they end pieces from here on.
2. Each shard gets the ids of its frequent words and builds a bidirectional FM-index: the Burrows-Wheeler transforms of its ids and of
   the reversed ids, with rows put in order by as many words as the longest phrase has. An interval of rows is a phrase, its length
   the count; a phrase keeps its interval in both transforms, so it can be extended to either side.
3. Phrases grow by a word a round: words to the right, then pairs to the left, then triples to the right. Every shard finds the
   intervals of its frequent phrases by backward search and extends them by all words that stand there; a longer phrase can be frequent
   only if both its parts without an end word are, and the interval it lies in tells whether the other part is. A task goes through up to ``GROUP``
   shards of a language one after another and adds up their counts, so a phrase is one row of the group. Counts of the groups are added
   up, those below ``min_count`` go.
4. Scores, and the best extension to the left and right of each candidate, are joins of the phrases found. A longer candidate that
   holds a phrase holds one a word longer than it that is at least as frequent, so extensions by one word decide what goes.

Shards have a bounded number of words (a piece is never cut, so one piece may exceed it), whatever a language holds; a phrase is one row a
group of shards, and only counts meet. Index files have names of their own attempt and are read by the names in tables.

Defined results: null texts count as empty, null languages as ``und``; empty texts and empty tables give no phrases; equal rows count each; fewer
candidates than ``top`` are all returned. Only ``text`` and ``lang`` are read, so further columns may have any name.
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rollcall.llm.common import stored, to_python
from rollcall.llm.tokenids import _filesystem
from rollcall.operators.picking import with_dense_ids
from rollcall.scratch import scratch_path

MIN_COUNT = 30
LONGEST = 4
TOP = 2000
SCALE = 2_000_000
COVERED = 80
SHARD_WORDS = 3_000_000
#: Most shards whose counts a task adds up.
GROUP = 4
#: Groups for each core, while there are as many shards.
TURNS = 3
#: Rows of a batch that leaves Python.
_ROWS = 1 << 16
_HALF = 0xFFFFFFFF

#: A-Z become a-z, ends of pieces line feeds, tabs blanks; all other bytes stay.
_PIECE_BYTES = bytes(10 if b in b".,;:!?\n\v\f\r" else 32 if b == 9 else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_TOKEN = re.compile(rb"[^ \n]+|\n")


def tokens(text: bytes | None) -> list[bytes]:
    """The words of UTF-8 text in order, with a line feed where a piece ends."""
    return _TOKEN.findall((text or b"").translate(_PIECE_BYTES))


def _write(path: str, name: str, *arrays: np.ndarray) -> None:
    """A file of arrays of 32-bit integers: how many, their lengths, their values."""
    files, root = _filesystem(path)
    files.create_dir(root, recursive=True)
    head = np.array([len(arrays), *map(len, arrays)], "<i8").tobytes()
    with files.open_output_stream(f"{root}/{name}") as out:
        out.write(zstandard.ZstdCompressor(1).compress(head + b"".join(a.astype("<i4").tobytes() for a in arrays)))


def _number() -> int:
    """A number for a file of this attempt."""
    return uuid.uuid4().int >> 66


def _file(number: int) -> str:
    return f"words-{number:x}"


def _read(path: str, name: str) -> list[np.ndarray]:
    files, root = _filesystem(path)
    with files.open_input_file(f"{root}/{name}") as source:
        raw = zstandard.ZstdDecompressor().decompress(source.read())
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    lengths = np.frombuffer(raw, "<i8", n, 8)
    ends = 8 + 8 * n + 4 * np.cumsum(lengths)
    return [np.frombuffer(raw, "<i4", int(k), int(end - 4 * k)) for k, end in zip(lengths, ends)]


def _drop(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def write_shards(docs: DataFrame, path: str, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(shard, lang, size, words, counts): the words of each shard by local id less 1, with their counts. Ids lie in the shard's file below ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[dict, list[np.ndarray]]] = {}
        sizes: dict[str, int] = {}

        def close(lang: str) -> pa.RecordBatch:
            known, parts = held.pop(lang)
            size, ids, shard = sizes.pop(lang), np.concatenate(parts), _number()
            _write(path, _file(shard), ids)
            counts = np.bincount(ids, minlength=len(known))[1:].tolist()
            columns = [pa.array([shard]), pa.array([lang]), pa.array([size]), pa.array([list(known)[1:]], pa.list_(pa.binary())), pa.array([counts], pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays(columns, names=["shard", "lang", "size", "words", "counts"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = tokens(text)
                if not found:
                    continue
                found.append(b"\n")
                if lang not in held:
                    known: dict = defaultdict()
                    known.default_factory = known.__len__
                    held[lang] = (known, [np.array([known[b"\n"]], np.int32)])
                    sizes[lang] = 0
                known, parts = held[lang]
                parts.append(np.fromiter(map(known.__getitem__, found), np.int32, len(found)))
                sizes[lang] += len(found)
                if sizes[lang] >= shard_words:
                    yield close(lang)
        for lang in sorted(held):
            yield close(lang)

    given = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text"))
    return to_python(given).mapInArrow(run, "shard long, lang string, size long, words array<binary>, counts array<long>")


def _rotations(symbols: np.ndarray, depth: int) -> np.ndarray:
    """The rotations in the order of their first ``depth`` symbols, by doubling. Equal ones come in any order."""
    rank, done = symbols.astype(np.int64), 1
    while True:
        step = min(done, depth - done)
        key = rank * (int(rank.max()) + 1) + np.roll(rank, -step)
        order = np.argsort(key)
        done += step
        if done >= depth:
            return order
        key = key[order]
        rank[order] = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]]))


class Transform:
    """One Burrows-Wheeler transform: the symbol before each rotation, and the places of each symbol in order for rank queries."""

    def __init__(self, before: np.ndarray):
        self.before = before.astype(np.int64)
        self.places = np.sort(self.before * len(before) + np.arange(len(before)))

    @classmethod
    def of(cls, symbols: np.ndarray, depth: int) -> Transform:
        return cls(symbols[_rotations(symbols, depth) - 1])

    def before_row(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """A step of backward search: the first row of ``symbol`` followed by what the rows from ``row`` on start with."""
        return np.searchsorted(self.places, symbol * len(self.before) + row)

    def find(self, words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(low, n) of phrases, given as the symbols of their last words, of those before the last, and so on."""
        low, high = np.zeros(len(words[0]), np.int64), np.full(len(words[0]), len(self.before))
        for symbol in words:
            low, high = self.before_row(symbol, low), self.before_row(symbol, high)
        return low, high - low

    def extended(self, low: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        """All words before the rotations of disjoint intervals: (interval, symbol, low, n, words of the interval that are smaller)."""
        starts = np.concatenate([[0], np.cumsum(n)])
        owner = np.repeat(np.arange(len(n)), n)
        symbols = int(self.before.max()) + 1
        pair = np.sort(owner * symbols + self.before[np.arange(starts[-1]) + (low - starts[:-1])[owner]])
        new = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]])) if len(pair) else np.zeros(0, np.int64)
        counts = np.diff(np.concatenate([new, [len(pair)]]))
        word = pair[new] % symbols > 0
        new, counts = new[word], counts[word]
        o, s = pair[new] // symbols, pair[new] % symbols
        return o, s, self.before_row(s, low[o]), counts, new - starts[o]


class WordIndex:
    """A bidirectional FM-index over the ids of a shard. Symbol 0 ends pieces; symbol i is the word with id ``ids[i - 1]``."""

    def __init__(self, forward: Transform, backward: Transform, ids: np.ndarray):
        self.forward, self.backward, self.ids = forward, backward, ids.astype(np.int64)

    @classmethod
    def of(cls, symbols: np.ndarray, ids: np.ndarray, depth: int = LONGEST) -> WordIndex:
        """The index of symbols, 0 at the ends of pieces and for words left out."""
        symbols = np.concatenate([[0], symbols, [0]]).astype(np.int32)
        symbols = np.concatenate([[0], symbols[1:][(symbols[1:] > 0) | (symbols[:-1] > 0)]])  # runs of zeros as one
        return cls(Transform.of(symbols, depth), Transform.of(symbols[::-1], depth), ids)

    def words(self) -> tuple[np.ndarray, ...]:
        """(word id, low, back, n) of all single words. Both transforms order words alike, so the two intervals are one."""
        low, n = self.forward.find([np.arange(1, len(self.ids) + 1)])
        return self.ids, low, low, n

    def find(self, words: list[np.ndarray]) -> tuple[np.ndarray, ...]:
        """(low, back, n) of phrases, given as the ids of their first words, of their second words, and so on. n is 0 for those with a word the shard lacks."""
        at = [np.searchsorted(self.ids, w) for w in words]
        known = np.logical_and.reduce([self.ids[np.minimum(a, len(self.ids) - 1)] == w for a, w in zip(at, words)])
        symbols = [a + 1 for a in at]
        low, n = self.forward.find(symbols[::-1])
        return low, self.backward.find(symbols)[0], np.where(known, n, 0)

    def left(self, low: np.ndarray, back: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        """(phrase, word id, low, back, n) of all phrases with one more word before."""
        of, symbol, new, count, smaller = self.forward.extended(low, n)
        return of, self.ids[symbol - 1], new, back[of] + smaller, count

    def right(self, low: np.ndarray, back: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        """(phrase, word id, low, back, n) of all phrases with one more word after."""
        of, symbol, new, count, smaller = self.backward.extended(back, n)
        return of, self.ids[symbol - 1], low[of] + smaller, new, count

    def save(self, path: str, name: str) -> None:
        _write(path, name, self.forward.before, self.backward.before, self.ids)

    @classmethod
    def load(cls, path: str, name: str) -> WordIndex:
        forward, backward, ids = _read(path, name)
        return cls(Transform(forward), Transform(backward), ids)


def _inside(at: np.ndarray, low: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Whether each row lies in one of the disjoint intervals."""
    order = np.argsort(low)
    low, high = low[order], (low + n)[order]
    k = np.searchsorted(low, at, side="right") - 1
    return (k >= 0) & (at < high[np.maximum(k, 0)])


#: A phrase is two longs of two word ids each; what it lacks is 0.
_PHRASES = "shard long, k1 long, k2 long, n long"


def _phrase_table(shard: int, *columns: np.ndarray) -> pa.Table:
    arrays = [pa.array(np.full(len(columns[0]), shard, np.int64)), *(pa.array(c.astype(np.int64, copy=False)) for c in columns)]
    table = pa.table(arrays, names=["shard", "k1", "k2", "n"])
    return pa.Table.from_batches(table.to_batches(_ROWS), table.schema)


def _added(one: tuple[np.ndarray, ...], other: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """(*keys, n) in the order of the keys: counts of equal phrases added up."""
    keys = [np.concatenate(c) for c in zip(one[:-1], other[:-1])]
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    for i, key in enumerate(keys):
        keys[i] = key[order]
    new = np.flatnonzero(np.concatenate([[True], np.logical_or.reduce([k[1:] != k[:-1] for k in keys])])[: len(order)])
    n = np.concatenate([one[-1], other[-1]])[order]
    del order
    return *(k[new] for k in keys), np.add.reduceat(n, new) if len(new) else n


def _no_phrases(keys: int) -> tuple[np.ndarray, ...]:
    return *(np.zeros(0, np.int64) for _ in range(keys)), np.zeros(0, np.int32)


def _by_shard(df: DataFrame, shards: int) -> DataFrame:
    """Whole shards dealt to tasks, one each up to 4096: their work follows their words, which Spark can't see in these rows."""
    return df.repartitionByRange(max(1, min(shards, max(4096, shards // 16))), "shard")


def frequent_words(shards: DataFrame, min_count: int, shard_words: int) -> DataFrame:
    """(lang, word, f, of, shard, local): the frequent words of each shard. Shards of a task's end are put together, to up to twice ``shard_words``, under ``of``."""
    along = Window.partitionBy("lang").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    share = F.call_function("div", F.coalesce(F.sum("size").over(along), F.lit(0)).cast("long"), F.lit(shard_words))
    together = shards.select("shard", "lang", "size").withColumn("share", share).withColumn("of", F.min("shard").over(Window.partitionBy("lang", "share")))
    listed = shards.select("shard", "lang", "words", "counts").join(stored(together.select("shard", "of"), "phrase-together"), "shard")
    told = listed.select("lang", "of", "shard", F.posexplode(F.arrays_zip("words", "counts")).alias("local", "w"))
    counted = told.select("lang", F.col("w.words").alias("word"), "of", "shard", "local", F.sum("w.counts").over(Window.partitionBy("lang", "w.words")).alias("f"))
    return counted.where(F.col("f") >= min_count)


def build_indexes(frequent: DataFrame, words: DataFrame, path: str, to: str, shards: int, depth: int = LONGEST) -> DataFrame:
    """(index, of): an index for each ``of``, from the ids of its shards and the ids of their frequent words, by a new number of its own."""
    named = frequent.join(words.select("lang", "word", "id"), ["lang", "word"]).select(F.col("of").alias("shard"), F.col("shard").alias("part"), "local", F.col("id").cast("int").alias("id"))

    def build(group: pa.Table) -> pa.Table:
        part, local, word = (group[c].to_numpy() for c in ("part", "local", "id"))
        symbols, known = [], np.unique(word)
        for shard in np.unique(part):
            (ids,) = _read(path, _file(int(shard)))
            own = np.zeros(int(ids.max()) + 1, np.int32)
            own[local[part == shard] + 1] = np.searchsorted(known, word[part == shard]) + 1
            symbols.append(own[ids])
        number = _number()
        WordIndex.of(np.concatenate(symbols), known, depth).save(to, _file(number))
        return pa.table({"index": pa.array([number], pa.int64()), "of": pa.array([group["shard"][0].as_py()], pa.int64())})

    return _by_shard(named, shards).groupBy("shard").applyInArrow(build, "index long, of long")


def grouped(indexes: DataFrame, shards: DataFrame, group: int = GROUP, turns: int = TURNS) -> DataFrame:
    """(shard, index): indexes of a language put together, up to ``group`` under one number, fewer while a core has no ``turns`` of them."""
    n = indexes.count()
    groups = max(-(-n // group), min(n, turns * indexes.sparkSession.sparkContext.defaultParallelism), 1)
    place = F.row_number().over(Window.orderBy("lang", "of")).cast("long") - 1
    listed = indexes.join(shards.select(F.col("shard").alias("of"), "lang"), "of")
    return listed.select(F.call_function("div", place * groups, F.lit(max(n, 1))).alias("shard"), "index")


def first_pairs(indexes: DataFrame, shards: int, path: str) -> DataFrame:
    """Two-word phrases of the indexes (shard, index) put together under each shard, with their counts there."""

    def run(group: pa.Table) -> pa.Table:
        found = _no_phrases(1)
        for number in group["index"].to_pylist():
            index = WordIndex.load(path, _file(number))
            first, low, back, n = index.words()
            of, after, _, _, n = index.right(low, back, n)
            del index, low, back
            found = _added(found, (first[of] << 32 | after, n.astype(np.int32)))
        k1, n = found
        return _phrase_table(group["shard"][0].as_py(), k1, np.zeros(len(k1), np.int64), n)

    return _by_shard(indexes, shards).groupBy("shard").applyInArrow(run, _PHRASES)


def longer_phrases(phrases: DataFrame, shards: int, path: str, words: int, indexes: DataFrame | None = None) -> DataFrame:
    """Phrases of ``words`` words of every shard, from its frequent phrases of one word less.

    ``indexes`` has (shard, index), those put together under each shard; without it each shard's number is that of its index.
    """
    to_left = words % 2 == 1
    alone = indexes is None
    given = phrases.select("shard", "k1", "k2", F.lit(None).cast("long").alias("index"))
    if not alone:
        nothing = F.lit(0).cast("long")
        given = given.unionByName(indexes.select("shard", nothing.alias("k1"), nothing.alias("k2"), "index"))

    def run(group: pa.Table) -> pa.Table:
        shard, of_index = group["shard"][0].as_py(), group["index"].is_valid().to_numpy()
        known = group.select(["k1", "k2"]).filter(pa.array(~of_index))
        k1, k2 = (known[c].to_numpy() for c in ("k1", "k2"))
        found = _no_phrases(2)
        for number in [shard] if alone else group["index"].drop_null().to_pylist():
            index = WordIndex.load(path, _file(number))
            low, back, n = index.find([k1 >> 32, k1 & _HALF, k2 >> 32][: words - 1])
            here = n > 0
            low, back, n, h1, h2 = low[here], back[here], n[here], k1[here], k2[here]
            of, word, new_low, new_back, count = (index.left if to_left else index.right)(low, back, n)
            if to_left:
                fits = _inside(new_low, low, n)
                a, b = word << 32 | h1[of] >> 32, (h1[of] & _HALF) << 32 | h2[of] >> 32
            else:
                fits = _inside(new_back, back, n)
                a, b = h1[of], h2[of] | word
            del index, new_low, new_back, word
            found = _added(found, (a[fits], b[fits], count[fits].astype(np.int32)))
        return _phrase_table(shard, *found)

    return _by_shard(given, shards).groupBy("shard").applyInArrow(run, _PHRASES)


def _frequent(phrases: DataFrame, min_count: int) -> DataFrame:
    """The phrases of each shard, with ``f`` over all shards, that are frequent over all."""
    return phrases.withColumn("f", F.sum("n").over(Window.partitionBy("k1", "k2"))).where(F.col("f") >= min_count)


def _key(ids: list[Column]) -> Column:
    pair = [F.lit(0).cast("long")] * 4
    for i, word in enumerate(ids):
        pair[i] = word
    join = lambda a, b: F.shiftleft(a, 32).bitwiseOR(b)
    return F.struct(join(pair[0], pair[1]).alias("k1"), join(pair[2], pair[3]).alias("k2"))


def _ids() -> list[Column]:
    return [F.shiftright("k1", 32), F.col("k1").bitwiseAND(_HALF), F.shiftright("k2", 32), F.col("k2").bitwiseAND(_HALF)]


def count_phrases(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, shard_words: int = SHARD_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Frequent phrases (size, k1, k2, f) of 2 to ``longest`` words, frequent words (lang, word, f, id), and (lang, n) of all words."""
    if not 2 <= longest <= 4:
        raise ValueError("phrases have 2 to 4 words")
    spark = docs.sparkSession
    ids, path = scratch_path(spark, "phrase-ids"), scratch_path(spark, "phrase-index")
    shards = stored(write_shards(docs, ids, shard_words), "phrase-shards")
    frequent = stored(frequent_words(shards, min_count, shard_words), "phrase-frequent")
    words = stored(with_dense_ids(frequent.select("lang", "word", "f").distinct(), start=1), "phrase-words")
    if (words.agg(F.max("id")).first()[0] or 0) >= 1 << 31:
        raise ValueError("more frequent words than ids of 31 bits")
    built = stored(build_indexes(frequent, words, ids, path, shards.count(), longest), "phrase-indexes")
    _drop(spark, ids)
    indexes = stored(grouped(built, shards), "phrase-groups")
    groups, found = (indexes.agg(F.max("shard")).first()[0] or 0) + 1, []
    for size in range(2, longest + 1):
        grown = first_pairs(indexes, groups, path) if size == 2 else longer_phrases(found[-1], groups, path, size, indexes)
        found.append(stored(_frequent(grown, min_count), f"phrases-{size}"))
    summed = [p.groupBy("k1", "k2").agg(F.first("f").alias("f")).select(F.lit(size).alias("size"), "k1", "k2", "f") for size, p in enumerate(found, 2)]
    phrases = summed[0]
    for more in summed[1:]:
        phrases = phrases.unionByName(more)
    totals = shards.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, n: a + n)).alias("n"))
    return stored(phrases, "phrases"), words, totals


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, top: int = TOP, covered: int = COVERED, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score, left, right): the best phrases of each language.

    ``a`` counts the phrase, ``l`` and ``r`` its parts at the lowest-scoring cut; ``left`` and ``right`` count its best extension by
    a word before and after it, 0 where no such candidate is.
    """
    phrases, words, totals = count_phrases(docs, min_count, longest, shard_words)
    ids = _ids()
    parts = phrases.select("k1", "k2", "f").unionByName(words.select(F.shiftleft("id", 32).alias("k1"), F.lit(0).cast("long").alias("k2"), "f"))
    cuts = F.array(*[F.when(F.col("size") == size, F.struct(F.lit(k).alias("k"), _key(ids[:k]).alias("left"), _key(ids[k:size]).alias("right"))) for size in range(2, longest + 1) for k in range(1, size)])
    cut = phrases.select("k1", "k2", F.col("f").alias("a"), F.explode(F.array_compact(cuts)).alias("cut"))
    of = lambda side, name: parts.select(F.struct("k1", "k2").alias(side), F.col("f").alias(name))
    sided = cut.select("k1", "k2", "a", "cut.k", "cut.left", "cut.right").join(of("left", "l"), "left").join(of("right", "r"), "right")
    wide = "decimal(28,0)"
    score = F.call_function("div", F.col("a").cast(wide) * F.lit(SCALE).cast("decimal(10,0)"), (F.col("l") + F.col("r")).cast(wide))
    scored = sided.select("k1", "k2", "a", "l", "r", "k", score.alias("score")).groupBy("k1", "k2", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    shorter = lambda first: F.when(F.col("size") == 3, _key(ids[first : first + 2])).when(F.col("size") == 4, _key(ids[first : first + 3]))
    ends = F.array(F.struct(shorter(0).alias("of"), F.lit(0).cast("long").alias("left"), F.col("f").alias("right")), F.struct(shorter(1).alias("of"), F.col("f").alias("left"), F.lit(0).cast("long").alias("right")))
    around = phrases.where("size > 2").select(F.inline(ends)).groupBy("of").agg(F.max("left").alias("left"), F.max("right").alias("right"))
    around = around.select("of.k1", "of.k2", "left", "right")
    kept = scored.join(around, ["k1", "k2"], "left").select("k1", "k2", "a", "best", F.coalesce("left", F.lit(0)).alias("left"), F.coalesce("right", F.lit(0)).alias("right"))
    kept = kept.where(F.greatest("left", "right") * 100 < F.col("a") * covered)
    spelt = (
        kept.select("*", F.posexplode(F.filter(F.array(*ids), lambda i: i > 0)).alias("at", "id"))
        .join(words.select("id", "lang", F.col("word").cast("string").alias("word")), "id")
        .groupBy("k1", "k2")
        .agg(F.first("lang").alias("lang"), F.array_join(F.sort_array(F.collect_list(F.struct("at", "word")))["word"], " ").alias("phrase"), *[F.first(c).alias(c) for c in ("a", "best", "left", "right")])
        .select("lang", "phrase", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), F.col("best.score").alias("score"), "left", "right")
    )
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    best = spelt.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", "left", "right")


def phrase_report(docs: DataFrame, **options) -> DataFrame:
    """The collocations without their extensions."""
    return collocations(docs, **options).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations_sql(min_count: int = MIN_COUNT, longest: int = LONGEST, top: int = TOP, covered: int = COVERED) -> str:
    """All phrases of all texts, in SQL."""
    return rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang,
                  unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, size, array_to_string(w[s + 1:s + size], ' ') AS phrase
      FROM (SELECT lang, w, size, unnest(range(0, len(w) - size + 1)) AS s FROM w, (SELECT unnest(range(1, {longest + 1})) AS size) WHERE len(w) >= size)),
f AS (SELECT lang, size, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM f WHERE size = 1 GROUP BY lang),
c AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= {min_count}),
cut AS (SELECT lang, size, phrase, a, k, array_to_string(w[1:k], ' ') AS x, array_to_string(w[k + 1:size], ' ') AS y FROM (SELECT *, unnest(range(1, size)) AS k FROM c)),
s AS (SELECT cut.*, x.f AS l, y.f AS r, {SCALE}::HUGEINT * a // (x.f + y.f) AS score FROM cut
      JOIN f x ON x.lang = cut.lang AND x.phrase = cut.x JOIN f y ON y.lang = cut.lang AND y.phrase = cut.y),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_phrase AS (SELECT DISTINCT lang, array_to_string(w[i + 1:i + m], ' ') AS phrase, a
                 FROM (SELECT lang, size, w, a, m, unnest(range(0, size - m + 1)) AS i FROM c, (SELECT unnest(range(2, {longest})) AS m) WHERE m < size)),
gone AS (SELECT DISTINCT b.lang, b.phrase FROM best b JOIN inner_phrase i ON i.lang = b.lang AND i.phrase = b.phrase WHERE 100 * i.a >= {covered} * b.a),
ranked AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
           FROM best b ANTI JOIN gone ON gone.lang = b.lang AND gone.phrase = b.phrase)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN n USING (lang) WHERE rank <= {top}
"""
