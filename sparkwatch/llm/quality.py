"""Quality classifier: naive Bayes support vectors.

n-gram indicators are scaled by the log-count ratio of the two classes and go into a linear model with hinge loss, fitted by
dual coordinate descent. The n-grams are lower-cased words and runs of one to three word shapes, in which stretches of
upper-case letters, lower-case letters, digits and each sign are one character and a repeated word is a sign of its own.
They are hashed to ``1 << bits`` indicators.

The model is fitted on at most ``sample`` labelled rows, those with the smallest hash of their id (a bound, not a share:
the fit costs the same for any corpus). Class counts of indicators are summed in Spark. A fifth of the sample fits the curve
from margin to probability. Every row is scored in its scanning task; nothing is shuffled but the sample.

Defined results: a null or empty text has no indicators and is scored by the bias; rows without a label or with a null label
are not learned from; of repeated ids each row is scored; with no labels of one class every score is the share of class 1 (0.5
where there are none); further columns are ignored; an empty table gives no rows.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, stored

BITS = 18
SAMPLE = 6_000  # labelled rows a model is fitted on at most
CACHE_WORDS = 200_000
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def shape(word: str) -> str:
    kinds = ["a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else "a" if c.isalpha() else c for c in word]
    return "".join([k for k, _ in groupby(kinds)])[:16]


class Features:
    """Indicators of texts. What a word comes to is kept in a cache of bounded size."""

    def __init__(self, bits: int = BITS):
        self.bits = np.uint64(64 - bits)
        self.known: dict[str, int] = {}
        self.words: list[int] = []
        self.shapes: list[int] = []
        self.same = np.uint64(xxhash.xxh64_intdigest(b"=", 1))

    def codes(self, words: list[str]) -> np.ndarray:
        if len(self.known) > CACHE_WORDS:
            self.known, self.words, self.shapes = {}, [], []
        known = self.known
        for w in {w for w in words if w not in known}:
            known[w] = len(self.words)
            self.words.append(xxhash.xxh64_intdigest(w.lower().encode(), 2))
            self.shapes.append(xxhash.xxh64_intdigest(shape(w).encode(), 3))
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def of(self, text: str) -> np.ndarray:
        """Sorted distinct indicator numbers."""
        words = text.split()
        if not words:
            return np.array([], np.int64)
        codes = self.codes(words)
        distinct, back = np.unique(codes, return_inverse=True)
        word = np.array([self.words[c] for c in distinct.tolist()], np.uint64)
        shapes = np.array([self.shapes[c] for c in distinct.tolist()], np.uint64)[back]
        shapes[1:][codes[1:] == codes[:-1]] = self.same
        grams = [word, shapes * MIX[0]]
        if len(shapes) > 1:
            two = shapes[:-1] * MIX[0] + shapes[1:] * MIX[1]
            grams.append(two ^ (two >> np.uint64(29)))
        if len(shapes) > 2:
            three = shapes[:-2] * MIX[0] + shapes[1:-1] * MIX[1] + shapes[2:] * MIX[2]
            grams.append(three ^ (three >> np.uint64(31)))
        return np.unique((np.concatenate(grams) * MIX[1]) >> self.bits).astype(np.int64)


@dataclass
class Model:
    weights: np.ndarray  # by indicator, log-count ratio and linear weight in one
    ratios: np.ndarray  # for the length of a row
    bias: float
    slope: float
    offset: float

    def margin(self, features: np.ndarray) -> float:
        if not len(features):
            return self.bias
        length = float(np.sqrt(np.square(self.ratios[features]).sum()))
        return float(self.weights[features].sum()) / length + self.bias if length else self.bias

    def score(self, features: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(features) + self.offset, -30, 30))))


def coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], labels: np.ndarray, size: int, cost: float, rounds: int):
    """Weights and bias of a linear hinge-loss model: each dual variable in turn is set to its best value in [0, cost]."""
    weights, bias = np.zeros(size), 0.0
    alpha = np.zeros(len(rows))
    norms = np.array([np.square(v).sum() + 1 for v in values])
    order, rng = np.arange(len(rows)), np.random.default_rng(7)
    for _ in range(rounds):
        rng.shuffle(order)
        largest = 0.0
        for i in order.tolist():
            slack = labels[i] * (weights[rows[i]] @ values[i] + bias) - 1
            new = min(max(alpha[i] - slack / norms[i], 0.0), cost)
            if change := (new - alpha[i]) * labels[i]:
                weights[rows[i]] += change * values[i]
                bias += change
                alpha[i] = new
                largest = max(largest, abs(change))
        if largest < 1e-4 * cost:
            break
    return weights, bias


def logistic(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the curve from margin to probability, by Newton steps on smoothed targets."""
    positive = (labels > 0).sum()
    target = np.where(labels > 0, (positive + 1) / (positive + 2), 1 / (len(labels) - positive + 2))
    slope, offset = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + offset, -30, 30)))
        w, r = p * (1 - p) + 1e-9, target - p
        gradient = np.array([(r * margins).sum() - 1e-3 * slope, r.sum()])
        mixed = (w * margins).sum()
        hessian = np.array([[(w * margins**2).sum() + 1e-3, mixed], [mixed, w.sum() + 1e-6]])
        step = np.linalg.solve(hessian, gradient)
        slope, offset = slope + step[0], offset + step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(slope), float(offset)


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, bits: int, sample: int) -> Model:
    """Model of the rows of ``labels`` (those to learn from); their texts come from ``docs``."""
    chosen = (
        labels.filter(F.col(label_col).isNotNull())
        .select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("label"))
        .dropDuplicates(["__id"])
        .orderBy(F.xxhash64("__id"), "__id")
        .limit(sample)
    )

    def task(batches):
        features = Features(bits)
        for batch, texts in chunks(batches, "text"):
            ids = [features.of(t or "").astype(np.int32) for t in texts]
            yield pa.record_batch([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["label", "features"])

    # at most `sample` rows of two numbers
    texts = docs.select(F.col(id_col).alias("__doc"), F.col(text_col).alias("text"))
    rows = texts.join(F.broadcast(chosen), F.col("__doc") == F.col("__id")).select("label", "text")
    learned = stored(rows.mapInArrow(task, "label int, features array<int>"), "quality-sample")
    totals = {r["label"]: r["n"] for r in learned.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    size = 1 << bits
    n, positive = sum(totals.values()), totals.get(1, 0)
    if not 0 < positive < n:
        share = (positive + 1) / (n + 2) if n else 0.5
        return Model(np.zeros(size), np.zeros(size), 0.0, 0.0, float(np.log(share / (1 - share))))
    # one row per indicator at most
    counts = (
        learned.select("label", F.explode("features").alias("f"))
        .groupBy("f")
        .agg(F.sum((F.col("label") == 1).cast("long")).alias("p"), F.count(F.lit(1)).alias("n"))
        .toArrow()
    )
    at, pos, both = (counts.column(c).to_numpy() for c in ("f", "p", "n"))
    ratios = np.zeros(size)
    p, q = 1.0 + pos, 1.0 + both - pos
    ratios[at] = np.log(p / (positive + 2)) - np.log(q / (n - positive + 2))
    ratios[at[both < 3]] = 0.0  # too rare to tell
    fetched = learned.toArrow()
    y = np.where(fetched.column("label").to_numpy() == 1, 1.0, -1.0)
    lists = fetched.column("features").combine_chunks()
    flat, ends = lists.flatten().to_numpy(), np.cumsum(np.diff(lists.offsets.to_numpy()))
    rows = np.split(flat, ends[:-1])  # views, no copies
    values = []
    for r in rows:
        v = ratios[r]
        length = np.sqrt(np.square(v).sum())
        values.append(v / length if length else v)
    part = np.arange(len(rows)) % 5 == 0
    pick = lambda xs, mask: [x for x, m in zip(xs, mask, strict=True) if m]
    weights, bias = coordinate_descent(pick(rows, ~part), pick(values, ~part), y[~part], size, 1.0, 40)
    model = Model(weights * ratios, ratios, bias, 1.0, 0.0)
    margins = np.array([model.margin(r) for r in pick(rows, part)])
    if len(set(y[part])) == 2:
        model.slope, model.offset = logistic(margins, y[part])
    return model


def quality_column(model: Model, spark, bits: int = BITS):
    """Column function: score of a text column."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scores(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        features = Features(bits)
        for texts in parts:
            found: list[float] = []
            for _, part in chunks([pa.record_batch([texts], ["text"])]):
                found += [shared.value.score(features.of(t or "")) for t in part]
            yield pa.array(found, pa.float64())

    return scores


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    bits: int = BITS,
    sample: int = SAMPLE,
    score_col: str = "score",
) -> DataFrame:
    """``docs`` with the probability of label 1 in ``score_col``, learned from the rows of ``labels``."""
    model = fit(docs, labels, id_col, text_col, label_col, bits, sample)
    return docs.withColumn(score_col, quality_column(model, docs.sparkSession, bits)(F.col(text_col)))
