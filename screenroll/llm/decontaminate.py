"""Benchmark decontamination: n-gram seeds, exact bounds, then Smith-Waterman alignment of words.

Test items are the query set. Their word 3-grams are looked up in every text. An item that shares
one is aligned with the words around the hits, unless bounds on the score (which words of the item
the text has, how many stand close together) show that no alignment can reach ``THRESHOLD`` of a
perfect one. So copies with words replaced, left out or put in are found as long as three words in
a row are unchanged, however often the copy or any of its seeds occurs: no seed is left out for
being frequent. Case and ASCII punctuation do not matter.

The pass is narrow: texts are never shuffled. Items come to the driver in blocks of bounded size,
each block is a pass of its own, so memory does not grow with the benchmark.

Defined results: NULL and empty texts or items match nothing; items without an id are left out;
rows without an id are reported with a NULL id; repeated rows give repeated results, repeated
items one result each; items of fewer than three words are left out (no seed); an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_texts, slices, stage
from .tokens import ngram_hashes, word_hashes

SEED_WORDS = 3
ITEM_BLOCK = 20_000
MATCH, MISMATCH, GAP = 2, -1, -1
THRESHOLD = 0.5
_LEAK = "doc_id long, item_id long, score double, first_word int, last_word int"


def words_of(text: bytes) -> np.ndarray:
    return word_hashes(text, lower=True, plain=True)


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment score of two word sequences, and its first and last word in the passage.

    One numpy step per item word: gaps along the passage come from a running maximum.
    """
    n = len(passage)
    slope = np.arange(n) * -GAP
    score, start = np.zeros(n + 1, np.int64), np.arange(n + 1)
    best = (0, 0, 0)
    for word in item:
        diagonal = score[:-1] + np.where(passage == word, MATCH, MISMATCH)
        up = score[1:] + GAP
        cell = np.maximum(np.maximum(diagonal, up), 0)
        begin = np.where(cell == 0, np.arange(n), np.where(diagonal >= up, start[:-1], start[1:]))
        lifted = cell + slope
        reach = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == reach, np.arange(n), 0))
        score[1:], start[1:] = reach - slope, begin[source]
        at = int(score.argmax())
        if score[at] > best[0]:
            best = (int(score[at]), int(start[at]), at - 1)
    return best


@dataclass
class Items:
    """A block of items: their words, and for every seed hash the items that have it."""

    ids: list[int]
    words: list[np.ndarray]

    def __post_init__(self):
        grams = [np.unique(ngram_hashes(w, SEED_WORDS)) for w in self.words]
        every = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        order = np.argsort(every, kind="stable")
        self.owner = owner[order]
        self.seeds, first = np.unique(every[order], return_index=True)
        self.bounds = np.append(first, len(every))
        self.own_seeds = [np.searchsorted(self.seeds, g) for g in grams]
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        flat = np.concatenate(self.words) if grams else every
        self.vocabulary, self.numbers = np.unique(flat, return_inverse=True)

    def hits(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in a text, and seed numbers, of the seeds that it holds."""
        if not len(self.seeds) or not len(grams):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.seeds, grams), len(self.seeds) - 1)
        found = np.flatnonzero(self.seeds[at] == grams)
        return found, at[found]

    def possible(self, text: np.ndarray, seeds: np.ndarray, threshold: float) -> np.ndarray:
        """Items with one of the seeds of which the text has enough words for the threshold."""
        seeds = np.unique(seeds)
        items = np.unique(self.owner[_ranges(self.bounds[seeds], self.bounds[seeds + 1] - self.bounds[seeds])])
        at = np.minimum(np.searchsorted(self.vocabulary, text), len(self.vocabulary) - 1)
        present = np.zeros(len(self.vocabulary), np.int64)
        present[at[self.vocabulary[at] == text]] = 1
        sizes = self.sizes[items]
        shared = np.add.reduceat(present[self.numbers[_ranges(self.starts[items], sizes)]], np.cumsum(sizes) - sizes)
        return items[shared >= threshold * sizes]

    def leaks(self, text: np.ndarray, threshold: float):
        """(item id, score, first word, last word) of the items that leaked into a text."""
        at, seeds = self.hits(ngram_hashes(text, SEED_WORDS))
        if not len(at):
            return
        for number in self.possible(text, seeds, threshold):
            words, best = self.words[number], (0, 0, 0)
            perfect = MATCH * len(words)
            # Every word put in costs a point, so no alignment at the threshold spans more words.
            span = len(words) + int((1 - threshold) * perfect) + 1
            own = at[np.isin(seeds, self.own_seeds[number])]
            edges = np.flatnonzero(np.diff(own, prepend=-2 * span - SEED_WORDS, append=len(text) + 2 * span) > span)
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                low = max(int(own[a]) + SEED_WORDS - span, 0)
                low, passage = _dense(words, text, low, int(own[b - 1]) + span, span, threshold)
                # A part of the item gains its words that the passage has and loses by the others.
                gain = np.cumsum(np.append(0, np.where(np.isin(words, passage), MATCH, -1)))
                if (gain - np.minimum.accumulate(gain)).max() < threshold * perfect:
                    continue
                score, first, last = align(words, passage)
                if score > best[0]:
                    best = (score, low + first, low + last)
                if score == perfect:
                    break
            if best[0] >= threshold * perfect:
                yield (self.ids[number], best[0] / perfect, *best[1:])


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one range after the other."""
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


def _dense(words: np.ndarray, text: np.ndarray, low: int, high: int, span: int, threshold: float):
    """The part of a passage, with its start, outside of which ``span`` words hold too few of the item's."""
    passage = text[low:high]
    held = np.cumsum(np.append(0, np.isin(passage, words)))
    width = min(span, len(passage))
    good = np.flatnonzero(held[width:] - held[:len(held) - width] >= threshold * len(words))
    if not len(good):
        return low, passage[:0]
    return low + int(good[0]), passage[good[0]:good[-1] + width]


def _blocks(benchmark: DataFrame, key: str, text: str):
    rows = benchmark.select(F.col(key).cast("long"), text).where(
        F.col(key).isNotNull() & F.col(text).isNotNull()).distinct().toLocalIterator()
    while block := list(islice(rows, ITEM_BLOCK)):
        pairs = [(i, words_of(t.encode())) for i, t in block]
        pairs = [(i, w) for i, w in pairs if len(w) >= SEED_WORDS]
        if pairs:
            yield Items([i for i, _ in pairs], [w for _, w in pairs])


def find_leaks(df: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
               item_key: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``df`` and item that leaked into it: ids, score, first and last word."""
    own = df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    parts = []
    for items in _blocks(benchmark, item_key, item_text):

        def run(batches, items=items):
            for batch in slices(batches):
                out = [[], [], [], [], []]
                for doc, t in zip(batch.column("doc_id").to_pylist(), byte_texts(batch.column("text")), strict=True):
                    for leak in items.leaks(words_of(t), threshold):
                        for column, value in zip(out, (doc, *leak), strict=True):
                            column.append(value)
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(out, kinds, strict=True)], [c.split()[0] for c in _LEAK.split(", ")])

        part = own.mapInArrow(run, _LEAK)
        parts.append(part)
    if len(parts) > 1:
        parts = [stage(p, "leaks") for p in parts]
    if not parts:
        return df.sparkSession.createDataFrame([], _LEAK)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def keep_clean(df: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` into which no item leaked; each row is judged by its own text, whatever its id."""
    def without(items: Items):
        def clean(texts: pa.Array) -> pa.Array:
            leaks = (items.leaks(words_of(t), THRESHOLD) for t in byte_texts(texts))
            return pa.array([next(iter(found), None) is None for found in leaks], pa.bool_())

        return F.arrow_udf(clean, "boolean")(F.col(text))

    for items in _blocks(benchmark, "item_id", "text"):
        df = df.where(without(items))
    return df
