"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

A text becomes the hashed counts of its runs of one to three letters (words end in a blank, everything
but letters counts as one). Document frequencies are counted over all rows that may be learnt from.
Weights are fitted to a sample by follow-the-regularised-leader with elastic-net penalties: each
coordinate keeps its sum of adjusted gradients and of squared ones, and is zero until the first sum
exceeds the L1 penalty. Every shard of the sample goes on from the common state; Spark averages what
the shards changed, coordinate by coordinate, after each epoch. Other rows of the sample then choose
one temperature, which makes the probabilities honest. Scoring is one narrow pass.

The sample has about SAMPLE rows of each language (chosen by a hash of their ids); what reaches the
driver is the model (BUCKETS coordinates for each language) and the document frequencies.

Defined results: a NULL text, or one without a letter, is ``und`` with score 0, and so is every text if
nothing could be learnt; ties go to the language that sorts first; rows without an id are scored, not
learnt from; equal texts get equal results; an empty table gives an empty result; texts of any length
are read whole, in pieces; columns other than id, text and language are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from .common import remainder, slices, stage
from .tokens import mix

FOLDS, HELD_FOLD = 3, 1
#: Rows of each language in the sample, and the share of them that calibrates.
SAMPLE, CALIBRATING = 2500, 0.2
BUCKETS = 1 << 16
LONGEST = 3
#: Step size and its delay, penalties, documents in a step, shards and epochs.
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.02, 0.02
STEP, SHARDS, EPOCHS = 32, 4, 4
TEMPERATURES = np.geomspace(0.02, 50, 97)
UNKNOWN = "und"

_PIECE = 1 << 20
_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Which code points are letters; made once in a process."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def ngrams(text: str | None, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of a text, ascending, and how often each occurs; empty without a letter."""
    total = None
    text = text or ""
    last = np.array([32], np.uint64)  # a text starts like a word
    for start in range(0, len(text), _PIECE):
        codes = np.frombuffer(text[start:start + _PIECE].lower().encode("utf-32-le", "replace"), np.uint32)
        letter = _letters()[codes]
        # Of everything between two words one blank stays.
        before = np.concatenate([[last[-1] != 32], letter[:-1]])
        codes = np.where(letter, codes, 32).astype(np.uint64)[letter | before]
        line = np.concatenate([last, codes])
        if start + _PIECE >= len(text) and line[-1] != 32:
            line = np.append(line, np.uint64(32))
        at = len(last)  # n-grams that end before it have been counted
        sums, parts = line, [line[at:][line[at:] != 32]]
        for n in range(2, LONGEST + 1):
            sums = sums[:-1] * np.uint64(0x110003) + line[n - 1:]
            parts.append(sums[max(at - n + 1, 0):] * np.uint64(LONGEST + 1) + np.uint64(n))
        hashed = (mix(np.concatenate(parts)) % np.uint64(buckets)).astype(np.int64)
        counts = np.bincount(hashed, minlength=buckets)
        total = counts if total is None else total + counts
        last = line[-(LONGEST - 1):]
    if total is None or not len(at := np.flatnonzero(total)):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return at, total[at]


@dataclass
class Model:
    """Languages in order, inverse document frequencies, weights (bucket or constant, language), temperature."""

    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray | None = None
    temperature: float = 1.0

    def row(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """TF-IDF values of length one."""
        value = np.log1p(counts) * self.idf[at]
        return value / np.sqrt(value @ value)

    def logits(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self.row(at, counts) @ self.weights[at] + self.weights[-1]

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language of a text and the probability of that answer."""
        at, counts = ngrams(text, len(self.idf))
        if not len(at) or not self.languages:
            return UNKNOWN, 0.0
        p = softmax(self.logits(at, counts)[None, :] / self.temperature)[0]
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return raised / raised.sum(axis=-1, keepdims=True)


def leader(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Weights of the regularised leader: zero while \\|z\\| is at most L1; the constant (last) has no penalty."""
    l1, l2 = np.full((len(z), 1), L1), np.full((len(z), 1), L2)
    l1[-1], l2[-1] = 0.0, 0.0
    return -np.sign(z) * np.maximum(np.abs(z) - l1, 0.0) / ((BETA + np.sqrt(n)) / ALPHA + l2)


def follow(z: np.ndarray, n: np.ndarray, rows: list[tuple[np.ndarray, np.ndarray]], truth: np.ndarray) -> None:
    """One epoch over rows (buckets, values) with their languages, in steps of STEP; changes z and n."""
    constant = len(z) - 1
    for start in range(0, len(rows), STEP):
        part = rows[start:start + STEP]
        at = np.concatenate([np.append(a, constant) for a, _ in part])
        value = np.concatenate([np.append(v, 1.0) for _, v in part])
        of = np.repeat(np.arange(len(part)), [len(a) + 1 for a, _ in part])
        used, place = np.unique(at, return_inverse=True)
        whole = np.append(used, constant) if used[-1] != constant else used
        w = leader(z[whole], n[whole])[:len(used)]
        firsts = np.flatnonzero(np.diff(of, prepend=-1))
        error = softmax(np.add.reduceat(w[place] * value[:, None], firsts))
        error[np.arange(len(part)), truth[start:start + STEP]] -= 1
        slope = np.stack([np.bincount(place, value * error[of, c], len(used)) for c in range(z.shape[1])], axis=1)
        more = n[used] + slope**2
        z[used] += slope - (np.sqrt(more) - np.sqrt(n[used])) / ALPHA * w
        n[used] = more


def _frequencies(texts: DataFrame, text: str, buckets: int) -> np.ndarray:
    """Inverse document frequencies over all rows; tasks count first."""

    def run(batches):
        found, rows = np.zeros(buckets, np.int64), 0
        for batch in slices(batches):
            for t in batch.column(text).to_pylist():
                found[ngrams(t, buckets)[0]] += 1
            rows += batch.num_rows
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(found[at], rows))], ["bucket", "n"])

    sums = texts.select(text).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(buckets + 1)
    counts[sums.column("bucket").to_numpy()] = sums.column("n").to_numpy()  # -1: all rows
    return np.log((1 + counts[-1]) / (1 + counts[:-1])) + 1


def _sampled(labelled: DataFrame, key: str, lang: str, sample: int) -> tuple[list[str], DataFrame]:
    """Languages in order, and the rows of the sample with the number of their language and a hash in [0, 1)."""
    sizes = {r[0]: r["n"] for r in labelled.groupBy(lang).agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    chance = (F.shiftrightunsigned(F.xxhash64(F.col(key).cast("string")), 11).cast("double")) / float(1 << 53)
    share = F.lit(0.0)
    number = F.lit(-1)
    if languages:
        known = F.create_map(*[F.lit(v) for i, name in enumerate(languages) for v in (name, F.struct(
            F.lit(i).alias("number"), F.lit(min(1.0, sample / sizes[name])).alias("share")))])
        share, number = known[F.col(lang)]["share"], known[F.col(lang)]["number"]
    # Within the sample the hash is spread over [0, 1) again; it deals out shards and calibration rows.
    return languages, labelled.withColumn("_chance", chance / share).where(F.col("_chance") < 1).withColumn("_language", number)


def train(
    documents: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE, buckets: int = BUCKETS
) -> Model:
    """A model from the rows with id, text and language; choose the rows beforehand."""
    labelled = documents.where(F.col(text).isNotNull() & F.col(lang).isNotNull() & F.col(key).isNotNull()).select(key, text, lang)
    languages, chosen = _sampled(labelled, key, lang, sample)
    if not languages:
        return Model([], np.ones(buckets))
    model = Model(languages, _frequencies(labelled, text, buckets))

    def featured(batches):
        for batch in slices(batches):
            found = [ngrams(t, buckets) for t in batch.column(text).to_pylist()]
            use = [i for i, (at, _) in enumerate(found) if len(at)]
            rows = [model.row(*found[i]) for i in use]
            kept = batch.take(pa.array(use, pa.int64()))
            yield pa.RecordBatch.from_arrays([
                kept.column("_chance"), kept.column("_language"), pa.array([found[i][0] for i in use], pa.list_(pa.int64())),
                pa.array(rows, pa.list_(pa.float64()))], ["chance", "language", "at", "value"])

    rows = stage(chosen.select(text, "_chance", "_language").mapInArrow(
        featured, "chance double, language int, at array<long>, value array<double>"), "language-sample")
    fitting = rows.where(F.col("chance") >= CALIBRATING).withColumn(
        "shard", F.floor(F.col("chance") * 1e6).cast("long") % SHARDS)
    z = np.zeros((buckets + 1, len(languages)))
    n = np.zeros_like(z)
    for _ in range(EPOCHS):
        z, n = _epoch(fitting, z, n)
    model.weights = leader(z, n)
    model.temperature = _temperature(rows.where(F.col("chance") < CALIBRATING), model)
    return model


def _arrays(table) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    rows = [(np.array(a, np.int64), np.array(v)) for a, v in zip(
        table.column("at").to_pylist(), table.column("value").to_pylist(), strict=True)]
    return rows, table.column("language").to_numpy()


def _epoch(fitting: DataFrame, z: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """State after every shard went on from it: the mean of what they changed."""
    classes = z.shape[1]

    def run(table):
        rows, truth = _arrays(table.sort_by("chance"))
        new_z, new_n = z.copy(), n.copy()
        follow(new_z, new_n, rows, truth)
        at = np.flatnonzero((new_n != n).any(axis=1))
        change = np.hstack([new_z[at] - z[at], new_n[at] - n[at]])
        return pa.table({"bucket": pa.array(at), "change": pa.array(list(change), pa.list_(pa.float64()))})

    changes = fitting.groupBy("shard").applyInArrow(run, "bucket long, change array<double>")
    sums = changes.groupBy("bucket").agg(*[F.sum(F.col("change")[i]).alias(f"c{i}") for i in range(2 * classes)]).toArrow()
    if not sums.num_rows:
        return z, n
    at = sums.column("bucket").to_numpy()
    mean = np.stack([sums.column(f"c{i}").to_numpy() for i in range(2 * classes)], axis=1) / SHARDS
    z, n = z.copy(), n.copy()
    z[at] += mean[:, :classes]
    n[at] += mean[:, classes:]
    return z, n


def _temperature(rows: DataFrame, model: Model) -> float:
    """The temperature of the grid with the least log loss over all rows.

    Truth counts as 1 - 1 / (rows + 2), as in Platt's scaling, so that a faultless answer leaves room for doubt.
    """
    others = max(len(model.languages) - 1, 1)

    def run(batches):
        right, rest, count = np.zeros(len(TEMPERATURES)), np.zeros(len(TEMPERATURES)), 0
        for batch in slices(batches):
            found, truth = _arrays(batch)
            for (at, value), t in zip(found, truth, strict=True):
                logits = (value @ model.weights[at] + model.weights[-1])[None, :] / TEMPERATURES[:, None]
                logs = np.log(np.maximum(softmax(logits), 1e-300))
                right += logs[:, t]
                rest += (logs.sum(axis=1) - logs[:, t]) / others
                count += 1
        yield pa.RecordBatch.from_arrays([
            pa.array(np.arange(len(right)), pa.int32()), pa.array(right), pa.array(rest), pa.array([count] * len(right))],
            ["i", "right", "rest", "n"])

    sums = rows.mapInArrow(run, "i int, right double, rest double, n long").groupBy("i").agg(
        *[F.sum(c).alias(c) for c in ("right", "rest", "n")]).orderBy("i").collect()
    if not sums or not sums[0]["n"]:
        return 1.0
    doubt = 1 / (sums[0]["n"] + 2)
    return float(TEMPERATURES[np.argmax([(1 - doubt) * r["right"] + doubt * r["rest"] for r in sums])])


def predict(self, text: str | None) -> tuple[str, float]:
        """Language of a text and the probability of that answer."""
        at, counts = ngrams(text, len(self.idf))
        if not len(at) or not self.languages:
            return UNKNOWN, 0.0
        p = softmax(self.logits(at, counts)[None, :] / self.temperature)[0]
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return raised / raised.sum(axis=-1, keepdims=True)


def leader(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Weights of the regularised leader: zero while \\|z\\| is at most L1; the constant (last) has no penalty."""
    l1, l2 = np.full((len(z), 1), L1), np.full((len(z), 1), L2)
    l1[-1], l2[-1] = 0.0, 0.0
    return -np.sign(z) * np.maximum(np.abs(z) - l1, 0.0) / ((BETA + np.sqrt(n)) / ALPHA + l2)


def follow(z: np.ndarray, n: np.ndarray, rows: list[tuple[np.ndarray, np.ndarray]], truth: np.ndarray) -> None:
    """One epoch over rows (buckets, values) with their languages, in steps of STEP; changes z and n."""
    constant = len(z) - 1
    for start in range(0, len(rows), STEP):
        part = rows[start:start + STEP]
        at = np.concatenate([np.append(a, constant) for a, _ in part])
        value = np.concatenate([np.append(v, 1.0) for _, v in part])
        of = np.repeat(np.arange(len(part)), [len(a) + 1 for a, _ in part])
        used, place = np.unique(at, return_inverse=True)
        whole = np.append(used, constant) if used[-1] != constant else used
        w = leader(z[whole], n[whole])[:len(used)]
        firsts = np.flatnonzero(np.diff(of, prepend=-1))
        error = softmax(np.add.reduceat(w[place] * value[:, None], firsts))
        error[np.arange(len(part)), truth[start:start + STEP]] -= 1
        slope = np.stack([np.bincount(place, value * error[of, c], len(used)) for c in range(z.shape[1])], axis=1)
        more = n[used] + slope**2
        z[used] += slope - (np.sqrt(more) - np.sqrt(n[used])) / ALPHA * w
        n[used] = more


def _frequencies(texts: DataFrame, text: str, buckets: int) -> np.ndarray:
    """Inverse document frequencies over all rows; tasks count first."""

    def run(batches):
        found, rows = np.zeros(buckets, np.int64), 0
        for batch in slices(batches):
            for t in batch.column(text).to_pylist():
                found[ngrams(t, buckets)[0]] += 1
            rows += batch.num_rows
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(found[at], rows))], ["bucket", "n"])

    sums = texts.select(text).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(buckets + 1)
    counts[sums.column("bucket").to_numpy()] = sums.column("n").to_numpy()  # -1: all rows
    return np.log((1 + counts[-1]) / (1 + counts[:-1])) + 1


def _sampled(labelled: DataFrame, key: str, lang: str, sample: int) -> tuple[list[str], DataFrame]:
    """Languages in order, and the rows of the sample with the number of their language and a hash in [0, 1)."""
    sizes = {r[0]: r["n"] for r in labelled.groupBy(lang).agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    chance = (F.shiftrightunsigned(F.xxhash64(F.col(key).cast("string")), 11).cast("double")) / float(1 << 53)
    share = F.lit(0.0)
    number = F.lit(-1)
    if languages:
        known = F.create_map(*[F.lit(v) for i, name in enumerate(languages) for v in (name, F.struct(
            F.lit(i).alias("number"), F.lit(min(1.0, sample / sizes[name])).alias("share")))])
        share, number = known[F.col(lang)]["share"], known[F.col(lang)]["number"]
    # Within the sample the hash is spread over [0, 1) again; it deals out shards and calibration rows.
    return languages, labelled.withColumn("_chance", chance / share).where(F.col("_chance") < 1).withColumn("_language", number)


def train(
    documents: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE, buckets: int = BUCKETS
) -> Model:
    """A model from the rows with id, text and language; choose the rows beforehand."""
    labelled = documents.where(F.col(text).isNotNull() & F.col(lang).isNotNull() & F.col(key).isNotNull()).select(key, text, lang)
    languages, chosen = _sampled(labelled, key, lang, sample)
    if not languages:
        return Model([], np.ones(buckets))
    model = Model(languages, _frequencies(labelled, text, buckets))

    def featured(batches):
        for batch in slices(batches):
            found = [ngrams(t, buckets) for t in batch.column(text).to_pylist()]
            use = [i for i, (at, _) in enumerate(found) if len(at)]
            rows = [model.row(*found[i]) for i in use]
            kept = batch.take(pa.array(use, pa.int64()))
            yield pa.RecordBatch.from_arrays([
                kept.column("_chance"), kept.column("_language"), pa.array([found[i][0] for i in use], pa.list_(pa.int64())),
                pa.array(rows, pa.list_(pa.float64()))], ["chance", "language", "at", "value"])

    rows = stage(chosen.select(text, "_chance", "_language").mapInArrow(
        featured, "chance double, language int, at array<long>, value array<double>"), "language-sample")
    fitting = rows.where(F.col("chance") >= CALIBRATING).withColumn(
        "shard", F.floor(F.col("chance") * 1e6).cast("long") % SHARDS)
    z = np.zeros((buckets + 1, len(languages)))
    n = np.zeros_like(z)
    for _ in range(EPOCHS):
        z, n = _epoch(fitting, z, n)
    model.weights = leader(z, n)
    model.temperature = _temperature(rows.where(F.col("chance") < CALIBRATING), model)
    return model


def _arrays(table) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    rows = [(np.array(a, np.int64), np.array(v)) for a, v in zip(
        table.column("at").to_pylist(), table.column("value").to_pylist(), strict=True)]
    return rows, table.column("language").to_numpy()


def _epoch(fitting: DataFrame, z: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """State after every shard went on from it: the mean of what they changed."""
    classes = z.shape[1]

    def run(table):
        rows, truth = _arrays(table.sort_by("chance"))
        new_z, new_n = z.copy(), n.copy()
        follow(new_z, new_n, rows, truth)
        at = np.flatnonzero((new_n != n).any(axis=1))
        change = np.hstack([new_z[at] - z[at], new_n[at] - n[at]])
        return pa.table({"bucket": pa.array(at), "change": pa.array(list(change), pa.list_(pa.float64()))})

    changes = fitting.groupBy("shard").applyInArrow(run, "bucket long, change array<double>")
    sums = changes.groupBy("bucket").agg(*[F.sum(F.col("change")[i]).alias(f"c{i}") for i in range(2 * classes)]).toArrow()
    if not sums.num_rows:
        return z, n
    at = sums.column("bucket").to_numpy()
    mean = np.stack([sums.column(f"c{i}").to_numpy() for i in range(2 * classes)], axis=1) / SHARDS
    z, n = z.copy(), n.copy()
    z[at] += mean[:, :classes]
    n[at] += mean[:, classes:]
    return z, n


def _temperature(rows: DataFrame, model: Model) -> float:
    """The temperature of the grid with the least log loss over all rows."""

    def run(batches):
        loss = np.zeros(len(TEMPERATURES))
        for batch in slices(batches):
            found, truth = _arrays(batch)
            for (at, value), t in zip(found, truth, strict=True):
                logits = (value @ model.weights[at] + model.weights[-1])[None, :] / TEMPERATURES[:, None]
                loss -= np.log(np.maximum(softmax(logits)[:, t], 1e-300))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(loss)), pa.int32()), pa.array(loss)], ["i", "loss"])

    sums = rows.mapInArrow(run, "i int, loss double").groupBy("i").agg(F.sum("loss").alias("loss")).collect()
    losses = np.zeros(len(TEMPERATURES))
    losses[[r["i"] for r in sums]] = [r["loss"] for r in sums]
    return float(TEMPERATURES[losses.argmin()]) if losses.any() else 1.0


def predict(documents: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``lang_pred`` and ``score`` of every row; one narrow pass."""
    schema = StructType([documents.schema[key], StructField("lang_pred", StringType()), StructField("score", DoubleType())])

    def run(batches):
        for batch in slices(batches):
            found = [model.predict(t) for t in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(key), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                [key, "lang_pred", "score"])

    return documents.select(key, text).mapInArrow(run, schema)


def learnable(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows outside the held-out fold."""
    return df.where(remainder(key, FOLDS) != HELD_FOLD)


def report(documents: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per document: held_out, lang_pred and score."""
    model = train(learnable(documents, key), key)
    return predict(documents, model, key).select(
        key, F.coalesce(remainder(key, FOLDS) == HELD_FOLD, F.lit(False)).cast(BooleanType()).alias("held_out"), "lang_pred", "score")
