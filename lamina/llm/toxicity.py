"""Toxicity scores by non-negative positive-unlabelled learning.

The classifier is a sparse linear model over hashed word features (the word, its first
four and first five letters), trained from confirmed toxic texts and unlabelled ones. The risk of
calling unlabelled texts clean contains the toxic ones among them; the class prior says how many, and
their part is subtracted: risk = prior * loss(positives as toxic) + max(0, loss(unlabelled as
clean) - prior * loss(positives as clean)). While the second part is below zero the step
goes the other way on it, so the model is not driven to explain noise.

Training uses bounded samples: ``most_positive`` confirmed toxic rows and
``most_unlabelled`` rows of any kind, chosen by a hash of their id, with their whole texts.
The class prior is the toxic share of all labelled training rows. Every row is scored, on its whole text.

Null and empty texts are scored by the bias alone. Null ids are not held out. Repeated
label rows count once each; labels of null value are not positives. Without any positive row
the score is 0 everywhere. Other columns, also of the same names in ``labels``, are not inputs.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import is_held_out, slices, texts_of
from lamina.llm.units import Remembered
from lamina.session import Staging

DIMENSIONS = 1 << 18
FOLDS = 4
THRESHOLD = 0.3
#: Positives that must have a feature, and by how many standard errors its share among them
#: must be above that among unlabelled texts.
LEAST, CLEAR = 3, 4.5
MARKS = b".,;:!?\"'()[]{}#*$%&|<>-_"


def word_features(word: bytes) -> list[int]:
    bare = word.strip(MARKS)
    if not bare:
        return []
    named = [b"w" + bare] + [bytes([n]) + bare[:n] for n in (4, 5) if len(bare) >= n]
    return [zlib.crc32(f) % DIMENSIONS for f in named]


def words_of(text: str) -> set[bytes]:
    return set(text.encode().lower().split())


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def scorer(self):
        """Text to score; a word's weight is looked up once per worker."""
        weights = self.weights.astype(float)
        of_word = Remembered(lambda w: float(weights[word_features(w)].sum()), 500_000)
        bias = self.bias

        def score(text: str) -> float:
            at = bias + sum(map(of_word.__getitem__, words_of(text)))
            return 1.0 / (1.0 + float(np.exp(-np.clip(at, -60.0, 60.0))))

        return score


def softplus(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, x)


def train(
    rows: list[np.ndarray], positive: np.ndarray, prior: float, steps: int = 200,
    rate: float = 0.1, sparsity: float = 3e-4, least: int = LEAST, clear: float = CLEAR,
) -> Model:
    """Fit the non-negative risk. ``rows`` hold each text's features, repeats kept."""
    weights = np.zeros(DIMENSIONS)
    n_pos, n_unl = int(positive.sum()), int((~positive).sum())
    if not n_pos or not n_unl:
        return Model(weights, -60.0)
    sizes = np.array([len(r) for r in rows])
    flat = np.concatenate(rows).astype(np.int64)
    row = np.repeat(np.arange(len(rows)), sizes)
    n_of = [np.zeros(DIMENSIONS), np.zeros(DIMENSIONS)]  # texts with a feature: unlabelled, positive
    seen = np.unique(row * DIMENSIONS + flat)
    for kind in (0, 1):
        own = seen[positive[seen // DIMENSIONS] == kind] % DIMENSIONS
        n_of[kind] += np.bincount(own, minlength=DIMENSIONS)
    # Only what positives have clearly more often than unlabelled texts can speak for a text
    # being toxic; everything else is left at zero.
    share = (n_of[0] + n_of[1]) / len(rows)
    error = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / n_pos + 1 / n_unl))
    often = (n_of[1] >= least) & (n_of[1] / n_pos - n_of[0] / n_unl > clear * error)
    row, flat = row[often[flat]], flat[often[flat]]
    used, flat = np.unique(flat, return_inverse=True)
    w, bias = np.zeros(len(used)), float(np.log(prior / (1 - prior)))
    first, second = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for step in range(1, steps + 1):
        at = bias + np.bincount(row, w[flat], len(rows))
        sure = 1.0 / (1.0 + np.exp(-np.clip(at, -60, 60)))
        clean_unl = softplus(at[~positive]).mean()
        clean_pos = softplus(at[positive]).mean()
        slope = np.empty(len(rows))
        if clean_unl - prior * clean_pos >= 0:
            slope[positive] = prior * (sure[positive] - 1 - sure[positive]) / n_pos
            slope[~positive] = sure[~positive] / n_unl
        else:
            slope[positive] = prior * sure[positive] / n_pos
            slope[~positive] = -sure[~positive] / n_unl
        grad = np.append(np.bincount(flat, slope[row], len(used)), slope.sum())
        first = 0.9 * first + 0.1 * grad
        second = 0.99 * second + 0.01 * grad * grad
        pace = rate * (1 - (step - 1) / steps)
        move = pace * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-6)
        w, bias = w - move[:-1], bias - move[-1]
        pull = pace * sparsity / (np.sqrt(second[:-1] / (1 - 0.99**step)) + 1e-6)
        w = np.sign(w) * np.maximum(np.abs(w) - pull, 0)
    weights[used] = w
    # A text without any of these features is no likelier toxic than the prior says; steps
    # against noise in a small sample can leave the bias above that.
    return Model(weights, float(min(bias, np.log(prior / (1 - prior)))))


def features_of(docs: DataFrame, used: np.ndarray) -> DataFrame:
    """Each text's features that are in ``used``, repeats kept."""

    def run(batches):
        for batch in slices(batches, 500):
            rows = []
            for t in batch.column("text").to_pylist():
                found = np.array([f for w in words_of(t) for f in word_features(w)], np.int32)
                rows.append(found[np.isin(found, used)].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("positive"), pa.array(rows, pa.binary())], names=["positive", "features"]
            )

    return docs.mapInArrow(run, "positive boolean, features binary")


def clear_features(docs: DataFrame, n_pos: int, n_unl: int, least: int, clear: float) -> np.ndarray:
    """Features that at least ``least`` positives have and that stand out among them, counted by
    Spark; :func:`train` draws the line itself, so a little more than it needs is let through."""

    def run(batches):
        for batch in slices(batches, 500):
            kinds, features = [], []
            for positive, t in zip(batch.column("positive").to_pylist(), batch.column("text").to_pylist()):
                found = {f for w in words_of(t) for f in word_features(w)}
                features.extend(found)
                kinds.extend([positive] * len(found))
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds, pa.bool_()), pa.array(features, pa.int32())], names=["positive", "feature"]
            )

    counted = docs.mapInArrow(run, "positive boolean, feature int").groupBy("feature").agg(
        F.count_if("positive").alias("p"), F.count_if(~F.col("positive")).alias("u")
    )
    share = (F.col("p") + F.col("u")) / F.lit(n_pos + n_unl)
    error = F.sqrt(F.greatest(share * (1 - share), F.lit(1e-12)) * (1 / n_pos + 1 / n_unl))
    apart = F.col("p") / n_pos - F.col("u") / n_unl > 0.999 * clear * error
    found = counted.where((F.col("p") >= least) & apart).select("feature").collect()
    return np.array(sorted(r["feature"] for r in found), np.int32)


def fit(
    docs: DataFrame, labels: DataFrame, most_positive: int = 1500, most_unlabelled: int = 6000
) -> Model:
    """Train on rows that are not held out."""
    texts = texts_of(docs)
    known = labels.select(
        labels["doc_id"].cast("long").alias("doc_id"), labels["toxic"].alias("toxic")
    ).where(~is_held_out(F.col("doc_id"), FOLDS))
    share = known.agg(F.avg(F.col("toxic").cast("double")).alias("p")).first()["p"] or 0.0
    prior = min(max(share, 1e-3), 0.9)

    def chosen(ids: DataFrame, most: int) -> DataFrame:
        return ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)

    positives = chosen(known.where("toxic = 1").select("doc_id").distinct(), most_positive)
    others = chosen(
        texts.select("doc_id").where(~is_held_out(F.col("doc_id"), FOLDS)), most_unlabelled
    )
    # Both samples are bounded, so they may be broadcast whatever the corpus is.
    sample = positives.withColumn("positive", F.lit(True)).union(
        others.distinct().withColumn("positive", F.lit(False))
    )
    staging = Staging(docs.sparkSession)
    chosen_texts = staging.write(texts.join(F.broadcast(sample), "doc_id"), "toxicity-sample")
    counts = {r["positive"]: r["count"] for r in chosen_texts.groupBy("positive").count().collect()}
    n_pos, n_unl = counts.get(True, 0), counts.get(False, 0)
    if not n_pos or not n_unl:
        staging.release()
        return Model(np.zeros(DIMENSIONS), -60.0)
    used = clear_features(chosen_texts, n_pos, n_unl, LEAST, CLEAR)
    found = features_of(chosen_texts, used).toPandas()
    staging.release()
    rows = [np.frombuffer(f, np.int32) for f in found["features"]]
    return train(rows, found["positive"].to_numpy(dtype=bool), prior)


def score_texts(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        score = held.value.scorer()
        for batch in slices(batches, 2000):
            scores = [score(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"]
            )

    scored = texts_of(docs).mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id",
        is_held_out(F.col("doc_id"), FOLDS).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` the model does not reject, all columns as they are."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    text, names = docs.columns.index("text"), [f"c{i}" for i in range(len(docs.columns))]

    def run(batches):
        score = held.value.scorer()
        for batch in slices(batches, 2000):
            kept = [score(t or "") < threshold for t in batch.column(text).to_pylist()]
            yield batch.filter(pa.array(kept, pa.bool_()))

    # By place, not by name: other columns may share a name.
    placed = docs.toDF(*names)
    return placed.mapInArrow(run, placed.schema).toDF(*docs.columns)
