"""Toxicity scores from a classifier that is indifferent to which group a sentence names."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.llm.common import stored

# Bounds of the fit: labelled rows of each class that it learns from, and features that it keeps.
SAMPLE_PER_CLASS = 6000
FEATURES = 2048
# A feature is kept only if it occurs in so many documents of the sample, and with a label more often than chance
# explains: the chi-squared statistic of one degree of freedom that so many features do not reach by chance.
MIN_DOCUMENTS = 4
MIN_CONTRAST = 15.0
# Stems tell more than words where words inflect: prefixes of these lengths are features too.
PREFIXES = (4, 5, 6, 7)
THRESHOLD = 0.7
RIDGE = 1e-5
SWAP_PENALTY = 1.0
STEPS = 400
CACHED_WORDS = 100_000
# Features whose counts a task holds before it hands them to Spark, which adds them up before the shuffle.
COUNTED_FEATURES = 100_000

# Terms of one group stand for each other in a swapped sentence.
IDENTITY_GROUPS = (
    ("women", "men"),
    ("woman", "man"),
    ("girl", "boy"),
    ("female", "male"),
    ("muslim", "christian", "jew", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("islam", "christianity", "judaism", "hinduism", "buddhism"),
    ("black", "white", "asian", "latino", "arab"),
    ("african", "european", "american", "mexican", "chinese", "indian"),
    ("gay", "straight", "lesbian", "bisexual"),
    ("transgender", "cisgender"),
    ("immigrant", "citizen", "refugee", "native"),
    ("immigrants", "citizens", "refugees", "natives"),
    ("deaf", "blind", "disabled"),
    ("femme", "homme"),
    ("femmes", "hommes"),
    ("musulman", "chrétien", "juif"),
    ("frau", "mann"),
    ("frauen", "männer"),
    ("moslem", "christ", "jude"),
    ("mujer", "hombre"),
    ("mujeres", "hombres"),
    ("musulmán", "cristiano", "judío"),
)
SWAPS = {term: group[(i + 1) % len(group)] for group in IDENTITY_GROUPS for i, term in enumerate(group)}
WORD = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> list[str]:
    return [word, *(word[:n] + "*" for n in PREFIXES if len(word) > n)]


def features(text: str, swap: bool = False) -> set[str]:
    """Words and stems that occur in a text; with ``swap`` as if each identity term were the next of its group."""
    found: set[str] = set()
    for token in set(text.split()):
        for word in WORD.findall(token.lower()):
            found.update(word_features(SWAPS.get(word, word) if swap else word))
    return found


@dataclass
class Model:
    index: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    intercept: float = 0.0

    def scorer(self):
        """A function from text to score that remembers the features of words, up to a bound."""
        index, weights, intercept = self.index, self.weights, self.intercept

        class Known(dict):
            def __missing__(self, token: str) -> tuple[int, ...]:
                if len(self) >= CACHED_WORDS:
                    self.clear()
                names = (n for word in WORD.findall(token.lower()) for n in word_features(word))
                self[token] = value = tuple(index[n] for n in names if n in index)
                return value

        known = Known()

        def score(text: str | None) -> float:
            present = sorted(set().union(*map(known.__getitem__, set((text or "").split()))))
            z = intercept + float(weights[present].sum()) if present else intercept
            return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))

        return score


def fit(
    rows: Iterable[tuple[list[int], list[int], int]],
    index: dict[str, int],
    ridge: float = RIDGE,
    swap_penalty: float = SWAP_PENALTY,
    totals: tuple[int, int] | None = None,
) -> Model:
    """Logistic regression on (features, features after the swap, label), with a penalty on score changes by the swap.

    The penalty is the mean square of the change of the log-odds, so a term gets
    the weight of its whole group, and what the labels say about one group cannot
    be held against it. Without both classes the model is the smoothed share of label 1.
    ``totals`` are the numbers of rows with labels 0 and 1 that the given ones stand
    for: each row counts for its part of them, so scores do not depend on how many were drawn.
    """
    rows = list(rows)
    labels = np.array([label for *_, label in rows], float)
    model = Model(index, np.zeros(len(index)))
    positive = labels.sum()
    stands_for = np.array(totals if totals else (len(labels) - positive, positive), float)
    model.intercept = float(np.log((stands_for[1] + 1) / (stands_for[0] + 1)))
    if not 0 < positive < len(labels) or not index:
        return model

    def flat(position: int) -> tuple[np.ndarray, np.ndarray]:
        owner = np.repeat(np.arange(len(rows)), [len(r[position]) for r in rows])
        return owner, np.concatenate([np.asarray(r[position], np.int64) for r in rows] or [np.zeros(0, np.int64)])

    (owner, column), (swap_owner, swap_column) = flat(0), flat(1)
    changed = np.array([set(a) != set(b) for a, b, _ in rows])
    size, width = len(rows), len(index)
    # The mean weight of a row is 1.
    weight = np.where(labels > 0, stands_for[1] / positive, stands_for[0] / (size - positive)) * (size / stands_for.sum())

    def times(w: np.ndarray, own: np.ndarray, col: np.ndarray) -> np.ndarray:
        return np.bincount(own, w[col], size)

    def back(values: np.ndarray, own: np.ndarray, col: np.ndarray) -> np.ndarray:
        return np.bincount(col, values[own], width)

    weights, intercept = model.weights, model.intercept
    first, second = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, STEPS + 1):
        own = times(weights, owner, column)
        error = weight * (1 / (1 + np.exp(-np.clip(own + intercept, -500, 500))) - labels)
        gradient = back(error, owner, column) / size + ridge * weights
        if changed.any():
            change = np.where(changed, own - times(weights, swap_owner, swap_column), 0.0) / changed.sum()
            gradient += 2 * swap_penalty * (back(change, owner, column) - back(change, swap_owner, swap_column))
        gradient = np.append(gradient, error.mean())
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        move = 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        weights = weights - move[:-1]
        intercept -= move[-1]
    model.weights, model.intercept = weights, float(intercept)
    return model


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def usable_labels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``label`` and the number ``n`` of rows of each labelled document, without held-out ones."""
    usable = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    rows = docs.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    return usable.join(rows, "doc_id")


def labelled_sample(docs: DataFrame, usable: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """At most ``per_class`` labelled documents of each label, in the order of a hash of their id."""

    def of(label: int) -> DataFrame:
        rows = usable.filter(F.col("label") == label).select("doc_id", "label")
        return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)

    chosen = of(0).unionByName(of(1))  # 2 * per_class rows at most
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id").select("text", "label")


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: Counter[str] = Counter()
    toxic: Counter[str] = Counter()

    def rows() -> pa.RecordBatch:
        names = list(total)
        arrays = [pa.array(names, pa.string()), pa.array([total[n] for n in names], pa.int64()), pa.array([toxic[n] for n in names], pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, names=["feature", "n", "n_toxic"])

    for batch in batches:
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = features(text or "")
            total.update(found)
            if label:
                toxic.update(found)
            if len(total) > COUNTED_FEATURES:
                yield rows()
                total.clear()
                toxic.clear()
    yield rows()


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, width: int = FEATURES) -> Model:
    """Fit on a bounded sample of the labelled documents, weighted back to the share of each label among all of them.

    The tasks count and choose features, the driver gets their numbers.
    """
    usable = stored(usable_labels(docs, labels))
    of_label = {r["label"]: r["n"] for r in usable.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    sample = labelled_sample(docs, usable, per_class)
    counts = sample.mapInArrow(_counts, "feature string, n long, n_toxic long")
    counts = counts.groupBy("feature").agg(F.sum("n").alias("n"), F.sum("n_toxic").alias("n_toxic")).filter(F.col("n") >= MIN_DOCUMENTS)
    sizes = sample.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("n_toxic")).first()
    share = sizes["n_toxic"] / max(sizes["n"], 1)
    expected = F.col("n") * share
    contrast = (F.col("n_toxic") - expected) ** 2 / F.greatest(expected * (1 - share), F.lit(1e-9))
    top = counts.filter(contrast >= MIN_CONTRAST).orderBy(contrast.desc(), "feature").limit(width).collect()
    index = {r["feature"]: i for i, r in enumerate(top)}
    # Partners of an identity term are kept with it, so that a swap can move the weight.
    for term in [t for t in index if t in SWAPS]:
        group = next(g for g in IDENTITY_GROUPS if term in g)
        for partner in group:
            for name in word_features(partner):
                index.setdefault(name, len(index))

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            plain = [sorted(index[f] for f in features(t) if f in index) for t in texts]
            swapped = [sorted(index[f] for f in features(t, swap=True) if f in index) for t in texts]
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(plain, kind), pa.array(swapped, kind), batch.column(1)], names=["plain", "swapped", "label"])

    rows = sample.mapInArrow(numbers, "plain array<int>, swapped array<int>, label int").collect()
    return fit(sorted((r["plain"], r["swapped"], r["label"]) for r in rows), index, totals=(of_label.get(0, 0), of_label.get(1, 0)))


def score_documents(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row, over whole texts.

    Null and empty texts have the score of a text without known words. Repeated
    rows are scored each, a null id is not held out, other columns are left out.
    """
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("score", T.DoubleType())])

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.scorer()
        for batch in batches:
            values = [score(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.float64())], names=["doc_id", "score"])

    scored = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(scores, schema)
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def without_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` with a score below the threshold, all columns kept.

    A null or empty text has the score of a text without known words; each repeated row is judged alike.
    """
    names = docs.columns

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.scorer()
        for batch in batches:
            texts = batch.column(names.index("text")).to_pylist()
            yield batch.filter(pa.array([score(t) < threshold for t in texts], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
