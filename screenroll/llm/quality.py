"""Quality classifier: random Fourier features, ridge by summed normal equations, isotonic scores.

Each text becomes a few statistics. Random Fourier features of the scaled statistics approximate
a Gaussian kernel; every partition adds up its part of the normal equations, Spark sums them per
matrix entry, and the driver solves one system whose size is a parameter, not a count of rows.
Scores are then calibrated by isotonic regression over a fixed number of score bins. All labelled
rows that may be learnt from take part.

Defined results: a NULL text counts as empty, and empty texts get a score like any other; equal
texts get equal scores; without labels (or an empty table) every score is the same 0.5; label
rows without an id or value teach nothing, of several labels of one id the mean counts; columns
other than id and text are never read.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from .common import byte_texts, remainder, slices, stage

FEATURES = 192
GAMMA = 0.05
RIDGE = 1e-2
BINS = 1000
FOLDS, HELD_FOLD = 5, 0
THRESHOLD = 0.3
CLIP = 6.0

_CLASSES = np.zeros((256, 9))
for _b in range(256):
    _c = chr(_b)
    _CLASSES[_b] = [
        _b >= 128, _c.islower() and _b < 128, _c.isupper() and _b < 128, _c.isdigit() and _b < 128,
        _c in " \t\r\n\v\f", _c == "\n", _c in ".,;:?'\"", _c in "#$%&*@^~+=<>/\\|_{}[]", _c in "!|",
    ]
N_STATS = 9 + 10


def text_stats(text: bytes) -> np.ndarray:
    """Statistics of a text: shares of character classes, word and line shapes, repetition."""
    out = np.zeros(N_STATS)
    words = text.split()
    if not words:
        return out
    size, n = len(text), len(words)
    out[:9] = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _CLASSES / size
    lengths = np.fromiter(map(len, words), np.int64, n)
    counts = Counter(words)
    lines = text.split(b"\n")
    tails = Counter(w[-1] for w in words)
    odd = sum(v for c, v in tails.items() if c in b"#$%&*!|^~")
    out[9:] = [
        np.log1p(n), lengths.mean(), lengths.std(), np.log(lengths.max()), len(counts) / n,
        max(counts.values()) / n, sum(map(eq, words, islice(words, 1, None))) / n,
        len(set(lines)) / len(lines), np.log1p(n / len(lines)), odd / n,
    ]
    return out


def stats_table(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and statistics of every row; one narrow pass."""
    schema = StructType([df.schema[key], StructField("stats", ArrayType(DoubleType()))])

    def run(batches):
        for batch in slices(batches):
            rows = [text_stats(t).tolist() for t in byte_texts(batch.column(text))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array(rows, pa.list_(pa.float64()))], [key, "stats"])

    return df.select(key, text).mapInArrow(run, schema)


@dataclass
class Model:
    """Scaling, random features, ridge weights and the calibration curve."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None = None
    curve: tuple[np.ndarray, np.ndarray] | None = None

    def features(self, stats: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(7)
        turn = rng.normal(0, np.sqrt(2 * GAMMA), (N_STATS, FEATURES))
        shift = rng.uniform(0, 2 * np.pi, FEATURES)
        x = np.clip((stats - self.mean) / self.scale, -CLIP, CLIP)
        waves = np.sqrt(2 / FEATURES) * np.cos(x @ turn + shift)
        return np.hstack([np.ones((len(x), 1)), waves])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.curve is None:
            return np.full(len(stats), 0.5)
        return np.clip(np.interp(self.raw(stats), *self.curve), 0.0, 1.0)


def isotonic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over bins in ascending order: centres and values of the blocks."""
    blocks: list[list[float]] = []
    for xi, yi, ni in zip(x, y, n, strict=True):
        blocks.append([xi * ni, yi * ni, ni])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    sums = np.array(blocks)
    return sums[:, 0] / sums[:, 2], sums[:, 1] / sums[:, 2]


def _arrays(batch) -> tuple[np.ndarray, np.ndarray]:
    stats = np.array(batch.column("stats").to_pylist(), float).reshape(-1, N_STATS)
    return stats, batch.column("label").to_numpy(zero_copy_only=False)


def train(stats: DataFrame, labels: DataFrame, label: str, key: str = "doc_id") -> Model:
    """A model from all rows of ``stats`` that have a label; choose the rows beforehand.

    To the driver come two rows of moments, (FEATURES + 2) ** 2 / 2 sums and BINS bins.
    """
    truth = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(
        F.avg(F.col(label).cast("double")).alias("label"))
    rows = stage(stats.join(truth, key).select("stats", "label"), "quality-train")
    moments = rows.select(F.posexplode("stats").alias("i", "v")).groupBy("i").agg(
        F.avg("v").alias("mean"), F.stddev_pop("v").alias("scale")).orderBy("i").collect()
    if not moments:
        return Model(np.zeros(N_STATS), np.ones(N_STATS))
    scale = np.array([r["scale"] for r in moments])
    model = Model(np.array([r["mean"] for r in moments]), np.where(scale > 1e-9, scale, 1.0))
    width = FEATURES + 2
    upper = np.triu_indices(width)

    def normal(batches):
        total = np.zeros((width, width))
        for batch in slices(batches, 4096):
            x, y = _arrays(batch)
            both = np.hstack([model.features(x), y[:, None]])
            total += both.T @ both
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.ravel_multi_index(upper, (width, width)), pa.int32()), pa.array(total[upper])], ["i", "v"])

    sums = rows.mapInArrow(normal, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    whole = np.zeros(width * width)
    whole[[r["i"] for r in sums]] = [r["v"] for r in sums]
    whole = whole.reshape(width, width)
    whole = whole + np.triu(whole, 1).T
    n = whole[0, 0]
    model.weights = np.linalg.solve(
        whole[:-1, :-1] + RIDGE * n / FEATURES * np.eye(width - 1) * 1e-2, whole[:-1, -1])

    def binned(batches):
        for batch in slices(batches, 4096):
            x, y = _arrays(batch)
            raw = model.raw(x)
            at = np.clip(np.floor((raw + 0.5) / 2 * BINS), 0, BINS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw), pa.array(y)], ["bin", "raw", "label"])

    bins = rows.mapInArrow(binned, "bin int, raw double, label double").groupBy("bin").agg(
        F.avg("raw").alias("x"), F.avg("label").alias("y"), F.count("*").alias("n")).orderBy("bin").collect()
    model.curve = isotonic(*(np.array([r[c] for r in bins], float) for c in ("x", "y", "n")))
    return model


def score_stats(stats: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """Key and score of every row of a statistics table."""
    schema = StructType([stats.schema[key], StructField("score", DoubleType())])

    def run(batches):
        for batch in slices(batches, 4096):
            x = np.array(batch.column("stats").to_pylist(), float).reshape(-1, N_STATS)
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(model.score(x))], [key, "score"])

    return stats.mapInArrow(run, schema)


def keep_good(df: DataFrame, model: Model, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """The rows of ``df`` whose text scores at least ``threshold``; one narrow pass, no join, only texts go to Python."""

    def good(texts: pa.Array) -> pa.Array:
        x = np.array([text_stats(t) for t in byte_texts(texts)]).reshape(-1, N_STATS)
        return pa.array(model.score(x) >= threshold)

    return df.where(F.arrow_udf(good, "boolean")(F.col(text)))


def learnable(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows outside the held-out fold."""
    return df.where(remainder(key, FOLDS) != HELD_FOLD)


def report(documents: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality") -> DataFrame:
    """One row per document: held_out, score and prediction."""
    stats = stage(stats_table(documents, key), "quality-stats")
    model = train(learnable(stats, key), labels, label, key)
    return score_stats(stats, model, key).select(
        key, F.coalesce(remainder(key, FOLDS) == HELD_FOLD, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
