"""Toxicity by a counterfactual-regularised linear classifier over words and beginnings of words.

Training reads a bounded sample of the labelled rows. Spark counts features by label over the sample's whole texts
and keeps those that tell most of toxic texts. Every sentence of a training text that names a group of people is copied with the name
swapped for each other name of its kind, and the loss adds the squared change of the score over these pairs, so that a
neutral mention of one group weighs no more than that of another or of people at large. The model is a weight per feature, at
most ``FEATURES`` of them, which every task gets. Scoring reads each text once, in Arrow batches, without a shuffle.

Defined results: null and empty texts have no features and get the score of the constant alone; labels that are null or
of a missing document teach nothing; where a document has several labels the highest counts; with no labels, or
with one kind only, the score is the smoothed share of toxic rows. Repeated rows get equal scores. Columns that a score
does not need are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.llm.common import stored, to_python

#: Most labelled rows a model is trained on: those with the lowest hashes of their id.
SAMPLE_ROWS = 20_000
FEATURES = 2048
PREFIXES = (4, 5, 6)
THRESHOLD = 0.3
CACHED_WORDS = 200_000

# Names of groups of people by kind, with a neutral word first; names swap within a line.
IDENTITY = (
    "people muslims christians jews hindus buddhists atheists catholics",
    "person muslim christian jew hindu buddhist atheist catholic",
    "human islamic jewish muslim christian hindu buddhist",
    "people blacks whites asians latinos africans europeans immigrants refugees foreigners",
    "human black white asian latino african european immigrant refugee foreign",
    "people gays lesbians bisexuals heterosexuals transgender queers",
    "person gay lesbian bisexual heterosexual transgender queer straight",
    "person woman man girl boy",
    "people women men girls boys",
    "human disabled blind deaf autistic elderly",
    "menschen muslime christen juden hindus frauen männer schwule lesben flüchtlinge ausländer behinderte",
    "mensch muslim christ jude hindu frau mann",
    "gens musulmans chrétiens juifs hindous femmes hommes immigrés réfugiés étrangers handicapés",
    "personne musulman chrétien juif hindou femme homme immigré réfugié étranger handicapé",
    "personas musulmanes cristianos judíos hindúes mujeres hombres inmigrantes refugiados extranjeros",
    "persona musulmán cristiano judío hindú mujer hombre inmigrante refugiado extranjero",
)

_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[.!?\n]+")


def word_features(word: str) -> list[str]:
    """A lower-case word, and its beginnings marked by a star."""
    return [word, *(word[:n] + "*" for n in PREFIXES if len(word) > n)]


def _swaps() -> dict[str, tuple[str, ...]]:
    out: dict[str, set[str]] = {}
    for line in IDENTITY:
        names = line.split()
        for name in names:
            out.setdefault(name, set()).update(n for n in names if n != name)
    return {k: tuple(sorted(v)) for k, v in out.items()}


SWAPS = _swaps()


def counterfactuals(text: str) -> Iterator[tuple[tuple[str, ...], tuple[str, ...]]]:
    """For each sentence that names a group and each other name of its kind: features lost, features gained."""
    for sentence in _SENTENCE.split(text.lower()):
        words = _WORD.findall(sentence)
        for name in {w for w in words if w in SWAPS}:
            kept = {f for w in words if w != name for f in word_features(w)}
            lost = tuple(sorted(set(word_features(name)) - kept))
            for other in SWAPS[name]:
                gained = set(word_features(other)) - kept
                yield tuple(f for f in lost if f not in gained), tuple(sorted(gained - set(lost)))


@dataclass
class Model:
    """Weights by feature and the constant."""

    bias: float
    weights: dict[str, float] = field(default_factory=dict)

    def scorer(self):
        """A function from text to score that keeps what words weigh."""
        index = {f: i for i, f in enumerate(self.weights)}
        values = list(self.weights.values())
        known: dict[str, tuple[int, ...]] = {}

        def score(text: str | None) -> float:
            found: set[int] = set()
            for word in set(_WORD.findall((text or "").lower())):
                ids = known.get(word)
                if ids is None:
                    if len(known) >= CACHED_WORDS:
                        known.clear()
                    ids = known[word] = tuple(index[f] for f in word_features(word) if f in index)
                if ids:
                    found.update(ids)
            z = self.bias + math.fsum(values[i] for i in found)
            return 1 / (1 + math.exp(-z)) if z >= 0 else math.exp(z) / (1 + math.exp(z))

        return score


def _descend(rows: np.ndarray, cols: np.ndarray, y: np.ndarray, swaps: list[tuple[np.ndarray, np.ndarray, float]], width: int, l2: float, swap_weight: float, rounds: int) -> np.ndarray:
    """Weights and constant by accelerated gradient descent with Adam's step sizes."""
    n = len(y)
    w = np.zeros(width + 1)
    share = (y.sum() + 1) / (n + 2)
    w[-1] = math.log(share / (1 - share))
    pair_rows = np.concatenate([np.full(len(a) + len(b), i) for i, (a, b, _) in enumerate(swaps)]) if swaps else np.zeros(0, int)
    pair_cols = np.concatenate([np.concatenate([a, b]) for a, b, _ in swaps]).astype(int) if swaps else np.zeros(0, int)
    pair_sign = np.concatenate([np.concatenate([-np.ones(len(a)), np.ones(len(b))]) for a, b, _ in swaps]) if swaps else np.zeros(0)
    counts = np.array([c for *_, c in swaps], dtype=float)
    counts = counts / counts.sum() if len(counts) else counts
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        z = np.bincount(rows, weights=w[cols], minlength=n) + w[-1]
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        error = (p - y) / n
        grad = np.zeros_like(w)
        grad[:-1] = np.bincount(cols, weights=error[rows], minlength=width) + l2 * w[:-1]
        grad[-1] = error.sum()
        if len(counts):
            change = np.bincount(pair_rows, weights=w[pair_cols] * pair_sign, minlength=len(counts))
            grad[:-1] += np.bincount(pair_cols, weights=2 * swap_weight * (counts * change)[pair_rows] * pair_sign, minlength=width)
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad * grad
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
    return w


def held_out(doc_id: str | Column) -> Column:
    """Rows that no model may learn from."""
    key = (F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string")
    return F.pmod(F.crc32(F.coalesce(key, F.lit(""))), F.lit(4)) == 2


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, features: int = FEATURES, l2: float = 1e-4, swap_weight: float = 10.0, rounds: int = 300) -> Model:
    """A model from the rows of ``labels`` (doc_id, toxic) that are not held out, and their texts in ``docs``.

    The sample is broadcast: at most ``sample_rows`` rows of an id and a flag.
    """
    usable = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out("doc_id"))
    flags = usable.groupBy(F.col("doc_id").alias("id")).agg((F.max("toxic") > 0).cast("int").alias("flag"))
    chosen = flags.orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    sample = stored(
        docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("id")).select("text", "flag"), "toxicity-sample"
    )

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ones: Counter[str] = Counter()
        zeros: Counter[str] = Counter()
        pairs: Counter[tuple[str, str]] = Counter()

        def out() -> pa.RecordBatch:
            names = [*(ones.keys() | zeros.keys())]
            lost, gained = [None] * len(names) + [a for a, _ in pairs], [None] * len(names) + [b for _, b in pairs]
            full = names + [None] * len(pairs)
            hits = [ones[f] for f in names] + [0] * len(pairs)
            misses = [zeros[f] for f in names] + list(pairs.values())
            made = pa.record_batch(
                [pa.array(full, pa.string()), pa.array(lost, pa.string()), pa.array(gained, pa.string()), pa.array(hits, pa.int64()), pa.array(misses, pa.int64())],
                names=["feature", "lost", "gained", "ones", "zeros"],
            )
            ones.clear(), zeros.clear(), pairs.clear()
            return made

        for batch in batches:
            for text, flag in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = {f for w in set(_WORD.findall((text or "").lower())) for f in word_features(w)}
                (ones if flag else zeros).update(found)
                pairs.update((" ".join(a), " ".join(b)) for a, b in counterfactuals(text or ""))
                if len(ones) + len(zeros) > 1_000_000:
                    yield out()
        yield out()

    counts = stored(
        to_python(sample).mapInArrow(counted, "feature string, lost string, gained string, ones long, zeros long")
        .groupBy("feature", "lost", "gained")
        .agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros")),
        "toxicity-counts",
    )
    positive, n = sample.agg(F.coalesce(F.sum("flag"), F.lit(0)), F.count(F.lit(1))).first()
    bias = math.log((positive + 1) / (n - positive + 1))
    if not 0 < positive < n:
        return Model(bias)
    share = F.lit(positive / n)
    expected = (F.col("ones") + F.col("zeros")) * share
    telling = (F.col("ones") - expected) ** 2 / (expected + 1)
    top = [r[0] for r in counts.where("feature IS NOT NULL AND ones + zeros >= 2").where(F.col("ones") > expected).orderBy(telling.desc(), "feature").limit(features).select("feature").collect()]
    # Swapped names are features whatever they tell; their number is that of the fixed list.
    swapped = counts.where("feature IS NULL").select("lost", "gained", "zeros").collect()
    names = list(dict.fromkeys([*top, *sorted({f for r in swapped for f in f"{r[0]} {r[1]}".split()})]))
    index = {f: i for i, f in enumerate(names)}

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [sorted({index[f] for w in set(_WORD.findall((t or "").lower())) for f in word_features(w) if f in index}) for t in batch.column(0).to_pylist()]
            yield pa.record_batch([pa.array(rows, pa.list_(pa.int32())), batch.column(1)], names=["ids", "flag"])

    data = sample.mapInArrow(indexed, "ids array<int>, flag int").toPandas()
    lengths = data["ids"].map(len).to_numpy()
    rows = np.repeat(np.arange(len(data)), lengths)
    cols = np.concatenate(data["ids"].to_numpy()).astype(int) if lengths.sum() else np.zeros(0, int)
    swaps = [(np.array([index[f] for f in r[0].split()], int), np.array([index[f] for f in r[1].split()], int), float(r[2])) for r in sorted(swapped)]
    w = _descend(rows, cols, data["flag"].to_numpy(dtype=float), swaps, len(names), l2, swap_weight, rounds)
    return Model(float(w[-1]), {f: float(w[i]) for f, i in index.items() if w[i] != 0})


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc, score): every row of ``docs`` as a struct with the score of its ``text``, whatever its columns are called."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    schema = T.StructType([*rows.schema.fields, T.StructField("score", T.DoubleType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.scorer()
        for batch in batches:
            texts = batch.column(0).field("text").to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([score(t) for t in texts], pa.float64())], names=["doc", "score"])

    return to_python(rows).mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``, by a model of the labelled ones."""
    model = train(docs, labels, **options)
    return scored(docs.select("doc_id", "text"), model).select(
        "doc.doc_id", held_out("doc.doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, with their columns."""
    model = train(docs, labels, **options)
    return scored(docs, model).where(F.col("score") < threshold).select("doc.*")
