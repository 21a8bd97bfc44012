"""Audit of how far the sources of a language differ in their words, by a frequent-pattern tree of term rows.

The distance of two sources is a sum over all kept terms of ``f(p, q)``, where p and q are the smoothed shares of the term in the
two. Most terms are missing in most sources, and a missing term has the same share ``base`` wherever it is missing, so

    sum f(p, q) = V f(bp, bq) + sum over p's terms (f(p, bq) - f(bp, bq)) + sum over q's terms (f(bp, q) - f(bp, bq))
                + sum over common terms (f(p, q) - f(p, bq) - f(bp, q) + f(bp, bq))

The first three come from bases and from the histogram of each source's counts. The last, the pair corrections, come from a
tree: the row of a term is its nonzero (source, share) items in the order of the sources, equal rows are one row with a
multiplicity, and rows are inserted into a prefix tree. A node stands for all terms below it, so each (ancestor, node)
combination is corrected once, times the node's multiplicity.

Rows are dealt to tasks by ranges of the rows themselves, so shared prefixes meet; within a task they arrive in
order, and the tree is never held whole: a node is complete when the next row leaves it, so a task holds one path. A prefix
that two tasks share counts in each with its own part of the terms. Sources are taken in blocks of ``BLOCK``, a row
holds those of one block or of two, so no row and no task grows with the number of sources.

Arithmetic is exact: shares are at most 10^9 + 1, their products are taken as decimals, and each ``f`` and sum fits 64 bits.

Defined results: null text, lang and source count as empty text; a group without terms takes part with N = 0; a language without kept terms
has V = 0 and pair values 0; equal rows are documents of their own; an empty table gives no rows. Only ``text``, ``lang`` and
``source`` are read, so further columns may have any name. A long text is one document of many terms and is read whole.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rollcall.llm.common import stored, to_python

MIN_DOCS = 10
TOP = 10
SCALE = 1_000_000_000
#: Sources whose items may stand in one row of the tree; two such blocks meet in a row.
BLOCK = 64
#: Distinct (group, term) entries a task counts before it hands them on, and combinations and pairs it holds.
ENTRIES, COMBINATIONS, PAIRS = 400_000, 1 << 18, 1 << 20
#: Copies of the table of groups that the histogram of a large language is dealt over.
SALTS = 16

#: Bytes outside terms become blanks and A-Z become a-z; the bytes of all other characters stay.
_TERM_BYTES = bytes(b if 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def terms(text: bytes | None) -> list[bytes]:
    """The terms of UTF-8 text: runs of ASCII letters and characters beyond ASCII, with A-Z lower-cased."""
    return (text or b"").translate(_TERM_BYTES).split()


def _groups_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"))


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents, combined within each task as far as ``ENTRIES`` go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        held = 0
        for batch in batches:
            for lang, source, text in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                n, docs = counts.setdefault((lang, source), (Counter(), Counter()))
                found = terms(text)
                held -= len(n)
                n.update(found)
                docs.update(set(found))
                held += len(n)
                if held > ENTRIES:
                    yield from _entries(counts)
                    counts, held = {}, 0
        yield from _entries(counts)

    given = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"), F.col("text").cast("binary").alias("text"))
    return to_python(given).mapInArrow(run, "lang string, source string, term binary, n long, docs long")


def _entries(counts: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
    for (lang, source), (n, docs) in counts.items():
        names = list(n)
        for low in range(0, len(names), 1 << 16):
            part = names[low : low + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(part)), pa.array([source] * len(part)), pa.array(part, pa.binary()), pa.array([n[t] for t in part], pa.int64()), pa.array([docs[t] for t in part], pa.int64())],
                names=["lang", "source", "term", "n", "docs"],
            )


def _div(a: Column, b: Column) -> Column:
    """The whole part of a quotient, exact for longs and decimals."""
    return F.call_function("div", a, b)


def _share(n: Column, total: Column, kept: Column) -> Column:
    """The smoothed share of n occurrences among ``total`` of ``kept`` terms, in units of 1 / SCALE; null without terms."""
    wide = "decimal(28,0)"
    return F.when(kept > 0, 1 + _div((n + 2).cast(wide) * F.lit(SCALE).cast("decimal(10,0)"), (total + 2 * kept).cast(wide)))


def _distance(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), p + q)


class _Path:
    """The open path of a prefix tree that rows reach in order. A node left behind is complete and is corrected against its ancestors."""

    def __init__(self) -> None:
        self.items: list[tuple[int, int, int]] = []
        self.terms: list[int] = []
        self.open: list[list[int]] = [[], [], []]
        self.found: tuple[list[int], ...] = tuple([] for _ in range(7))
        self.sums: dict[tuple[int, int], int] = {}

    def leave(self, depth: int, low_end: int) -> None:
        """Closes the nodes deeper than ``depth``. Ancestors are all above, or those before item ``low_end`` if sources of two blocks meet."""
        while len(self.items) > depth:
            source, share, base = self.items.pop()
            for column in self.open:
                column.pop()
            m, at = self.terms.pop(), len(self.items)
            if at:
                self.terms[-1] += m
                above = sum(s < low_end for s in self.open[0]) if low_end else at
                if above and source >= low_end:
                    for column, own in zip(self.found, self.open):
                        column.extend(own[:above])
                    for column, own in zip(self.found[3:], (source, share, base, m)):
                        column.extend([own] * above)
        if len(self.found[0]) > COMBINATIONS:
            self.correct()

    def insert(self, items: list[tuple[int, int, int]], m: int, low_end: int) -> None:
        depth = 0
        for mine, new in zip(self.items, items):
            if mine != new:
                break
            depth += 1
        self.leave(depth, low_end)
        for item in items[depth:]:
            self.items.append(item)
            self.terms.append(0)
            for column, value in zip(self.open, item):
                column.append(value)
        self.terms[-1] += m

    def correct(self) -> None:
        """Adds up the combinations held: each corrected once, times the terms of its node."""
        if not self.found[0]:
            return
        a, p, bp, b, q, bq, m = (np.array(c, np.int64) for c in self.found)
        for column in self.found:
            column.clear()
        f = lambda x, y: (x - y) * (x - y) // (x + y)
        value = (f(p, q) - f(p, bq) - f(bp, q) + f(bp, bq)) * m
        key = (a << 32) | b
        order = np.argsort(key, kind="stable")
        key, value = key[order], value[order]
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        for k, v in zip(key[starts].tolist(), np.add.reduceat(value, starts).tolist()):
            pair = (k >> 32, k & 0xFFFFFFFF)
            self.sums[pair] = self.sums.get(pair, 0) + v

    def taken(self, lang: str) -> pa.RecordBatch:
        pairs, self.sums = self.sums, {}
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(pairs), pa.string()), *(pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)), pa.array(list(pairs.values()), pa.int64())],
            names=["lang", "lo", "hi", "value"],
        )


def _corrections(rows: DataFrame) -> DataFrame:
    """(lang, lo, hi, value): parts of the pair corrections, from term rows (lang, low, high, path, m)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, at, low_end = _Path(), None, 0
        for batch in batches:
            lists = batch.column("path")
            cuts = lists.offsets.to_pylist()
            items = list(zip(*(lists.values.field(k).to_pylist() for k in range(3))))
            for i, (lang, low, high, m) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("lang", "low", "high", "m")), strict=True)):
                if (lang, low, high) != at:
                    path.leave(0, low_end)
                    if at and lang != at[0]:
                        path.correct()
                        yield path.taken(at[0])
                    at, low_end = (lang, low, high), 0 if low == high else (low + 1) * BLOCK
                path.insert(items[cuts[i] : cuts[i + 1]], m, low_end)
                if len(path.sums) > PAIRS:
                    yield path.taken(lang)
        if at:
            path.leave(0, low_end)
            path.correct()
            yield path.taken(at[0])

    ordered = ["lang", "low", "high", "path"]
    return rows.repartitionByRange(*ordered).sortWithinPartitions(*ordered).mapInArrow(run, "lang string, lo long, hi long, value long")


def term_rows(items: DataFrame, blocks: int) -> DataFrame:
    """(lang, low, high, path, m) from items (lang, term, idx, p, base): each term's row in each block of sources, and in each two."""
    item = F.struct(F.col("idx"), F.col("p"), F.col("base"))
    cut = items.withColumn("block", _div(F.col("idx"), F.lit(BLOCK))).groupBy("lang", "term", "block").agg(F.sort_array(F.collect_list(item)).alias("path"))
    if blocks > 1:
        cut = stored(cut, "divergence-blocks")
    rows = cut.where("size(path) > 1").select("lang", F.col("block").alias("low"), F.col("block").alias("high"), "path")
    if blocks > 1:
        other = cut.select("lang", "term", F.col("block").alias("high"), F.col("path").alias("more"))
        both = cut.withColumnRenamed("block", "low").join(other, ["lang", "term"]).where("low < high")
        rows = rows.unionByName(both.select("lang", "low", "high", F.concat("path", "more").alias("path")))
    return rows.groupBy("lang", "low", "high", "path").agg(F.count(F.lit(1)).alias("m"))


def source_divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): for each source its distance to every other, and the terms it prefers.

    Part ``pair`` has all other sources of the language, part ``term`` the first ``top`` terms by their share of the distance
    between the source and its language.
    """
    of_term = Window.partitionBy("lang", "term")
    counted = term_counts(docs).repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    kept = stored(
        counted.withColumns({"in_lang": F.sum("docs").over(of_term), "lang_n": F.sum("n").over(of_term)})
        .where(F.col("in_lang") >= min_docs)
        .select("lang", F.col("term").cast("string").alias("term"), "source", "n", "lang_n"),
        "divergence-terms",
    )
    totals = kept.groupBy(F.col("lang").alias("of_lang"), F.col("source").alias("of_source")).agg(F.sum("n").alias("total"))
    langs = kept.groupBy("lang", "term").agg(F.first("lang_n").alias("n")).groupBy(F.col("lang").alias("in_lang")).agg(F.sum("n").alias("lang_total"), F.count(F.lit(1)).alias("kept"))
    zero = lambda name: F.coalesce(name, F.lit(0)).cast("long").alias(name)
    numbered = _groups_of(docs).distinct().withColumn("idx", (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("long"))
    groups = (
        numbered.join(totals, (F.col("lang") == F.col("of_lang")) & (F.col("source") == F.col("of_source")), "left")
        .join(langs, F.col("lang") == F.col("in_lang"), "left")
        .select("lang", "source", "idx", zero("total"), zero("lang_total"), zero("kept"))
    )
    groups = stored(groups.withColumn("base", _share(F.lit(0).cast("long"), F.col("total"), F.col("kept"))), "divergence-groups")
    items = stored(
        kept.join(groups, ["lang", "source"])
        .withColumns({"p": _share(F.col("n"), F.col("total"), F.col("kept")), "q": _share(F.col("lang_n"), F.col("lang_total"), F.col("kept"))})
        .select("lang", "source", "term", "idx", "p", "q", "base"),
        "divergence-items",
    )
    last = groups.agg(F.max("idx")).first()[0] or 0
    corrections = _corrections(term_rows(items, last // BLOCK + 1))
    left, right = groups.select("lang", F.col("idx").alias("lo"), F.col("base").alias("bp"), "kept"), groups.select("lang", F.col("idx").alias("hi"), F.col("base").alias("bq"))
    bases = left.join(right, "lang").where("lo < hi").select("lang", "lo", "hi", F.coalesce(F.col("kept") * _distance(F.col("bp"), F.col("bq")), F.lit(0)).alias("value"))
    histogram = items.groupBy("lang", "idx", "p", "base").agg(F.count(F.lit(1)).alias("m")).withColumn("salt", F.pmod(F.xxhash64("idx", "p"), F.lit(SALTS)))
    dealt = groups.select("lang", F.col("idx").alias("other"), F.col("base").alias("bq"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    single = F.col("m") * (_distance(F.col("p"), F.col("bq")) - _distance(F.col("base"), F.col("bq")))
    singles = histogram.join(dealt, ["lang", "salt"]).where("idx <> other").select("lang", F.least("idx", "other").alias("lo"), F.greatest("idx", "other").alias("hi"), single.alias("value"))
    sums = stored(bases.unionByName(singles).unionByName(corrections).groupBy("lang", "lo", "hi").agg(F.sum("value").alias("value")), "divergence-sums")
    both = sums.select("lang", F.explode(F.array(F.struct(F.col("lo").alias("idx"), F.col("hi").alias("other")), F.struct(F.col("hi").alias("idx"), F.col("lo").alias("other")))).alias("pair"), "value").select("lang", "pair.*", "value")
    names = groups.select("lang", "idx", "source")
    pairs = both.join(names, ["lang", "idx"]).join(names.select("lang", F.col("idx").alias("other"), F.col("source").alias("item")), ["lang", "other"])
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    ranked = pairs.select("lang", "source", "item", "value").withColumn("rank", place)
    own = items.where("p > q").select("lang", "source", F.col("term").alias("item"), _distance(F.col("p"), F.col("q")).alias("value"))
    own = own.withColumn("rank", place).where(F.col("rank") <= top)
    columns = lambda part: ("lang", "source", F.lit(part).alias("part"), "item", F.col("value").cast("long").alias("value"), F.col("rank").cast("int").alias("rank"))
    return ranked.select(*columns("pair")).unionByName(own.select(*columns("term")))


def divergence_sql(min_docs: int = MIN_DOCS, top: int = TOP) -> str:
    """All kept terms of all pairs of sources, in SQL."""
    p = lambda n, total, kept: f"1 + ({SCALE}::HUGEINT * ({n} + 2)) // ({total} + 2 * {kept})"
    return rf"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS doc,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
w AS (SELECT lang, source, doc, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY ALL HAVING count(DISTINCT doc) >= {min_docs}),
c AS (SELECT w.lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
l AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
t AS (SELECT g.lang, g.source, coalesce(sum(n), 0) AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (SELECT t.lang, t.source, kept.term, coalesce(c.n, 0) AS n, {p("coalesce(c.n, 0)", "t.total", "l.v")} AS p, {p("kept.n", "l.total", "l.v")} AS q
      FROM t JOIN kept USING (lang) JOIN l USING (lang) LEFT JOIN c ON c.lang = t.lang AND c.source = t.source AND c.term = kept.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
own AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM own))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM ranked WHERE part = 'pair' OR rank <= {top}
"""
