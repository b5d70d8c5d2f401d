"""Toxicity by multiple-instance learning: sentence scores, combined by noisy-or, learnt from document labels.

A sentence is toxic with probability sigmoid(bias + weights of its distinct features: words and
their first bytes, so that inflected forms count as well), a document
unless none of its sentences is: 1 - (1 - leak) * product(1 - p). Only documents are labelled; the
likelihood of their labels trains the word weights, so the model finds the offending sentences by
itself. It is fitted on the driver from a bounded sample of labelled rows (``SAMPLE`` rows of
each class, weighted back to the shares of the classes); the ``WORDS`` most telling features of toxic documents
are chosen by a Spark aggregate over it. Scoring is one narrow pass over whole texts.

Defined results: a NULL text counts as empty; empty texts score the leak; equal texts score
equally; label rows without an id or value teach nothing, of several labels of one id the largest
counts; without labels of both classes every score is the mean label (0 without any); other
columns than id and text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_texts, remainder, slices, stage
from .tokens import prefix_hashes, words_at

SAMPLE = 6000
WORDS = 600
PREFIXES = (4, 5)
STEPS, RATE, DECAY = 150, 0.1, 2e-4
FOLDS, HELD_FOLD = 4, 2
THRESHOLD = 0.3
OFFENDING = 0.5
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?\n"]] = True


def sentences(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature hashes of a text, the sentence number of each, and where each sentence ends (bytes)."""
    words, starts, stops = words_at(text, lower=True, plain=True)
    ends = np.flatnonzero(_ENDS[np.frombuffer(text, np.uint8)])
    features, at = [words], [starts]
    for k in PREFIXES:
        at.append(starts[stops - starts > k])
        features.append(prefix_hashes(text, at[-1], k, lower=True))
    return np.concatenate(features), np.searchsorted(ends, np.concatenate(at)), np.append(ends, len(text))


@dataclass
class Model:
    """Sorted word hashes with their weights, sentence bias and the leak."""

    words: np.ndarray
    weights: np.ndarray
    bias: float
    leak: float

    def sentence_scores(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers and probabilities of the sentences that hold known words, and all sentence ends."""
        words, sentence, ends = sentences(text)
        if not len(words) or not len(self.words):
            return words[:0].astype(int), np.zeros(0), ends
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        hit = np.flatnonzero(self.words[at] == words)
        pairs = np.unique(sentence[hit].astype(np.int64) * len(self.words) + at[hit])
        numbers, group = np.unique(pairs // len(self.words), return_inverse=True)
        total = self.bias + np.bincount(group, self.weights[pairs % len(self.words)], len(numbers))
        return numbers, 1 / (1 + np.exp(-total)), ends

    def score(self, text: bytes) -> float:
        p = self.sentence_scores(text)[1]
        return float(1 - (1 - self.leak) * np.exp(np.log1p(-np.minimum(p, 1 - 1e-12)).sum()))


def _sample(documents: DataFrame, labels: DataFrame, key: str, text: str, label: str):
    """Rows by label, and about SAMPLE labelled rows of each (all, if fewer), staged."""
    truth = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias("_id")).agg(
        F.max(F.col(label).cast("int")).alias("label")).where(remainder("_id", FOLDS) != HELD_FOLD)
    totals = {r["label"]: r["n"] for r in truth.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0)
    for value, n in totals.items():
        share = F.when(F.col("label") == value, int(min(1.0, SAMPLE / n) * (1 << 20))).otherwise(share)
    chosen = truth.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 20)) < share)
    rows = documents.select(F.col(key).cast("long").alias("_id"), F.col(text).alias("text")).join(F.broadcast(chosen), "_id")
    return totals, stage(rows.select(F.xxhash64("_id", "text").alias("row"), "label", "text"), "toxicity-sample")


def _vocabulary(rows: DataFrame, totals: dict[int, int]) -> np.ndarray:
    """Sorted hashes of the features that toxic documents have more often than chance has it, the most telling ones."""

    def run(batches):
        for batch in slices(batches):
            found = [np.unique(sentences(t)[0]) for t in byte_texts(batch.column("text"))]
            label = np.repeat(batch.column("label").to_numpy(), [len(f) for f in found])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(found).view(np.int64)), pa.array(label.astype(np.int32))], ["feature", "label"])

    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    one, zero = F.sum("label") / sizes[1], F.sum(1 - F.col("label")) / sizes[0]
    rate = F.count("*") / sum(sizes.values())
    chance = F.pow(one - zero, F.lit(2)) / F.greatest(rate * (1 - rate), F.lit(1e-9))
    counts = rows.mapInArrow(run, "feature long, label int").groupBy("feature").agg(F.count("*").alias("n"), chance.alias("c"), (one - zero).alias("more"))
    top = counts.where("n >= 3 and more > 0").orderBy(F.desc("c"), "feature").limit(WORDS).select("feature").collect()
    return np.sort(np.array([r[0] for r in top], np.int64).view(np.uint64))


def _known_features(rows: DataFrame, vocabulary: np.ndarray):
    """Label and (sentence, feature number) pairs of every sampled row, as Arrow."""

    def run(batches):
        for batch in slices(batches):
            codes = []
            for t in byte_texts(batch.column("text")):
                features, sentence, _ = sentences(t)
                at = np.minimum(np.searchsorted(vocabulary, features), len(vocabulary) - 1)
                hit = vocabulary[at] == features
                codes.append(np.unique(sentence[hit].astype(np.int64) * len(vocabulary) + at[hit]))
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(codes, pa.list_(pa.int64()))], ["label", "codes"])

    return rows.select("label", "text").mapInArrow(run, "label int, codes array<long>").toArrow()


def train(documents: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", text: str = "text") -> Model:
    """A model from labelled rows outside the held-out fold."""
    totals, rows = _sample(documents, labels, key, text, label)
    vocabulary = np.zeros(0, np.uint64)
    if rows.select("label").distinct().count() == 2:
        vocabulary = _vocabulary(rows, totals)
    if not len(vocabulary):
        known = sum(totals.values())
        mean = sum(v * n for v, n in totals.items()) / known if known else 0.0
        return Model(vocabulary, np.zeros(0), 0.0, mean)
    got = _known_features(rows, vocabulary)
    y = got.column("label").to_numpy().astype(float)
    codes = [c.values.to_numpy() for c in got.column("codes")]
    owner = np.repeat(np.arange(len(y)), [len(c) for c in codes])
    codes = np.concatenate(codes)
    sentence, feature = codes // len(vocabulary), codes % len(vocabulary)
    span = sentence.max(initial=0) + 1
    instances, instance = np.unique(owner * span + sentence, return_inverse=True)
    bag = instances // span
    weight = np.where(y == 1, totals[1] / y.sum(), totals[0] / (1 - y).sum())
    weight = weight / weight.mean()
    theta = np.zeros(len(vocabulary) + 2)
    theta[-2:] = -3.0, -4.0  # sentence bias, log-odds of the leak
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        p = 1 / (1 + np.exp(-theta[-2] - np.bincount(instance, theta[feature], len(instances))))
        leak = 1 / (1 + np.exp(-theta[-1]))
        quiet = np.bincount(bag, np.log1p(-np.minimum(p, 1 - 1e-9)), len(y)) + np.log1p(-leak)
        # Slope of the log-likelihood along the log of the probability that no sentence is toxic.
        slope = weight * np.where(y == 1, -np.exp(quiet) / np.maximum(-np.expm1(quiet), 1e-9), 1.0)
        toward = slope[bag] * p
        grad = np.empty_like(theta)
        grad[:-2] = np.bincount(feature, toward[instance], len(vocabulary))
        grad[-2:] = toward.sum(), slope.sum() * leak
        grad /= len(y)
        grad[:-2] += DECAY * theta[:-2]
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad ** 2
        theta -= RATE * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return Model(vocabulary, theta[:-2], float(theta[-2]), float(1 / (1 + np.exp(-theta[-1]))))


def score(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` without its text, with ``score``."""
    rest = df.drop("score")
    schema = rest.drop(text).withColumn("score", F.lit(0.0)).schema

    def run(batches):
        for batch in slices(batches):
            scores = pa.array([model.score(t) for t in byte_texts(batch.column(text))], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in schema.names[:-1]] + [scores], schema.names)

    return rest.mapInArrow(run, schema)


def offending(df: DataFrame, model: Model, text: str = "text", threshold: float = OFFENDING) -> DataFrame:
    """``df`` with ``offending``: sentences (text and score) that score at least ``threshold``, in order."""
    rest = df.drop("offending")
    schema = rest.selectExpr("*", "cast(null as array<struct<sentence:string,score:double>>) as offending").schema
    kind = pa.list_(pa.struct([("sentence", pa.string()), ("score", pa.float64())]))

    def run(batches):
        for batch in slices(batches):
            found = []
            for t in byte_texts(batch.column(text)):
                numbers, p, ends = model.sentence_scores(t)
                found.append([
                    {"sentence": t[ends[i - 1] + 1 if i else 0:ends[i] + 1].decode().strip(), "score": float(s)}
                    for i, s in zip(numbers.tolist(), p, strict=True) if s >= threshold])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], schema.names)

    return rest.mapInArrow(run, schema)


def report(documents: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per document: held_out, score and prediction."""
    model = train(documents, labels, key=key)
    return score(documents.select(key, "text"), model).select(
        key, F.coalesce(remainder(key, FOLDS) == HELD_FOLD, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
