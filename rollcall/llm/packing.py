"""Variable-capacity best-fit packing of documents into sequences of several permitted lengths.

Items of equal length are interchangeable, so the packing is planned on the histogram of lengths, which has at most as
many rows as the largest capacity, however many documents there are. Lengths go from long to short; an item goes to the
open bin it fills best; bins of one history move together as a group with a count. Where nothing fits, a bin opens. How
large, is settled jointly for all lengths: the plan is made for each opening rule (the least permitted capacity of at
least 1, 2, 4, .. times the item, up to the largest), every bin shrinks at the end to the least capacity that
holds its contents, and the plan of the least total cost is taken. A bin costs its capacity, a fixed ``overhead``, and what attention
over it costs, which grows with the square of the capacity, so short documents are worth short bins.

The plan is a list of runs: items of length L with ranks from a to b go to the bins from c on. Spark numbers the items of each
length (in buckets of their ids, so that a common length is no single task) and looks the ranks up. A document longer
than the largest capacity is cut into full pieces and a rest; nothing is dropped.

Defined results: null and empty texts are one piece of length 0 without a bin; equal rows are separate items; null ids count as
empty text when items are numbered; an empty table gives no rows. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rollcall.llm.common import stored, words_in

CAPACITIES = (512, 1024, 2048, 4096, 8192)
OVERHEAD = 16
#: Capacity at which attention costs as much as all else.
ATTENTION = 32_768
NUMBER_BUCKETS = 256


@dataclass
class Group:
    """``count`` bins with equal contents: (length, how many) from long to short."""

    count: int
    contents: tuple[tuple[int, int], ...]
    used: int


@dataclass
class Plan:
    """Groups with their final capacities, and their cost."""

    groups: list[tuple[int, Group]]
    cost: float

    def runs(self) -> dict[int, np.ndarray]:
        """For each length, rows (first rank, first bin, bins, capacity, offset) in the order of ranks."""
        found: dict[int, list[tuple[int, int, int, int, int]]] = defaultdict(list)
        rank: dict[int, int] = defaultdict(int)
        bin_id = 0
        for capacity, group in self.groups:
            offset = 0
            for length, times in group.contents:
                found[length].append((rank[length], bin_id, group.count, capacity, offset))
                rank[length] += group.count * times
                offset += length * times
            bin_id += group.count
        return {length: np.array(rows, np.int64) for length, rows in found.items()}


def _fill(lengths: Sequence[tuple[int, int]], capacities: Sequence[int], stretch: float) -> list[Group]:
    """Best fit in the order given. ``lengths`` has (length, items), from long to short."""
    by_rest: dict[int, list[Group]] = defaultdict(list)
    rests = 0  # bit r is set where bins with r left are open
    sizes: dict[int, int] = {}

    def put(group: Group, capacity: int) -> None:
        nonlocal rests
        rest = capacity - group.used
        sizes[id(group)] = capacity
        by_rest[rest].append(group)
        rests |= 1 << rest

    for length, items in lengths:
        while items:
            fitting = rests >> length
            if not fitting:
                capacity = next((c for c in capacities if c >= length * stretch), capacities[-1])
                each = capacity // length
                if items >= each:
                    put(Group(items // each, ((length, each),), length * each), capacity)
                if items % each:
                    put(Group(1, ((length, items % each),), length * (items % each)), capacity)
                items = 0
                continue
            rest = length + (fitting & -fitting).bit_length() - 1
            group = by_rest[rest].pop()
            capacity = sizes.pop(id(group))
            each = min(rest // length, items)
            count = min(group.count, items // each)
            if not by_rest[rest]:
                rests &= ~(1 << rest)
            if count < group.count:
                put(Group(group.count - count, group.contents, group.used), capacity)
            put(Group(count, (*group.contents, (length, each)), group.used + length * each), capacity)
            items -= count * each
    return [group for groups in by_rest.values() for group in groups]


def bin_cost(capacity: int, overhead: int = OVERHEAD, attention: float = ATTENTION) -> float:
    return capacity + overhead + capacity * capacity / attention


def plan_bins(histogram: dict[int, int], capacities: Sequence[int] = CAPACITIES, overhead: int = OVERHEAD, attention: float = ATTENTION) -> Plan:
    """The least costly plan for ``histogram`` (length to items); no length is above the largest capacity."""
    capacities = sorted(set(capacities))
    lengths = sorted(((k, v) for k, v in histogram.items() if k > 0 and v > 0), reverse=True)
    best: Plan | None = None
    stretch = 1.0
    while True:
        groups = [(next(c for c in capacities if c >= g.used), g) for g in _fill(lengths, capacities, stretch)]
        cost = sum(bin_cost(c, overhead, attention) * g.count for c, g in groups)
        if best is None or cost < best.cost:
            best = Plan(sorted(groups, key=lambda x: (x[0], x[1].contents)), cost)
        if stretch > capacities[-1] / min(capacities[0], lengths[-1][0] if lengths else capacities[0]):
            return best
        stretch *= 2


def _numbered(items: DataFrame) -> DataFrame:
    """Adds ``rank`` from 0 among the items of equal length."""
    spread = items.withColumn("part", F.pmod(F.xxhash64(F.coalesce(F.col("id").cast("string"), F.lit("")), "piece"), F.lit(NUMBER_BUCKETS)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = spread.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")).select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "part").orderBy("id", "piece", "row")
    return spread.withColumn("within", F.row_number().over(inside) - 1).join(offsets, ["length", "part"]).withColumn("rank", (F.col("before") + F.col("within")).cast("long"))


def pack(
    docs: DataFrame, capacities: Sequence[int] = CAPACITIES, overhead: int = OVERHEAD, attention: float = ATTENTION, length: Column | None = None
) -> DataFrame:
    """(doc_id, piece, start, length, bin_id, capacity, offset): a row for every piece of every row of ``docs``.

    ``length`` is the size of a document, by default its number of words; ``start`` counts from the start of the
    document, ``offset`` from the start of the bin.
    """
    largest = max(capacities)
    sizes = docs.select(F.col("doc_id").alias("id"), (words_in("text") if length is None else length.cast("long")).alias("size")).withColumn("row", F.monotonically_increasing_id())
    pieces = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0).cast("long"), F.floor((F.col("size") - 1) / F.lit(largest)))))
    items = stored(
        sizes.withColumn("piece", pieces)
        .withColumn("start", F.col("piece") * largest)
        .select("id", "row", "piece", "start", F.least(F.lit(largest).cast("long"), F.col("size") - F.col("start")).alias("length")),
        "pack-items",
    )
    histogram = {r[0]: r[1] for r in items.where("length > 0").groupBy("length").agg(F.count(F.lit(1))).collect()}
    runs = plan_bins(histogram, capacities, overhead, attention).runs()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            out = np.zeros((3, len(lengths)), np.int64)
            for value in np.unique(lengths):
                rows = runs[int(value)]
                here = lengths == value
                first, bin_id, bins, capacity, offset = rows[np.searchsorted(rows[:, 0], ranks[here], side="right") - 1].T
                at = ranks[here] - first
                out[:, here] = bin_id + at % bins, capacity, offset + value * (at // bins)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "piece", "start", "length")), *map(pa.array, out)], names=["doc_id", "piece", "start", "length", "bin_id", "capacity", "offset"])

    schema = f"doc_id {dict(items.dtypes)['id']}, piece long, start long, length long, bin_id long, capacity long, offset long"
    placed = _numbered(items.where("length > 0")).select("id", "piece", "start", "length", "rank").mapInArrow(place, schema)
    none = F.lit(None).cast("long")
    empty = items.where("length = 0").select(F.col("id").alias("doc_id"), "piece", "start", "length", none.alias("bin_id"), none.alias("capacity"), none.alias("offset"))
    return placed.unionByName(empty)


def sequences(packed: DataFrame) -> DataFrame:
    """(bin_id, capacity, used, spans): one row per bin with its pieces in place. A bin holds at most its capacity."""
    spans = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "start", "length")))
    return packed.where("bin_id IS NOT NULL").groupBy("bin_id", "capacity").agg(F.sum("length").alias("used"), spans.alias("spans"))
