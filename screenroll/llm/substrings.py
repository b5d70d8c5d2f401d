"""Removal of long repeated word runs by compaction of the De Bruijn graph of the corpus.

The edges of the graph are all runs of 50 words; a document is a walk. Edges are dealt to nodes
by their minimizer, the 16-word anchor of least hash within the run, so that neighbouring edges
with one anchor form a local path, compacted to a single row at once: anchor, label (hash of the
words of the path and the anchor's place in it), document, first word, number of edges. Then

1. a join with the anchors that occur in several documents drops all paths that cannot repeat;
2. equal labels are one nonbranching path. A path whose label begins in a smaller document is
   covered as a whole, after a second hash of its words agrees with that of the source path at
   its coordinates (document, first word);
3. where an anchor has several labels the graph branches: one path of each label is expanded to
   its single edges, which are grouped and joined in the same way;
4. covered paths and edges are joined to their documents by coordinates and become word ranges.

All groupings are aggregates with map-side parts and joins against one row per key, which Spark
splits when a key is hot; nothing is collected per anchor. Only documents that have covered
words (and those with branching paths) are shuffled with their text.

Defined results: a NULL text has no words; a row without an id keeps all its words and is never a
source; rows with equal id are one document; equal rows give equal results; texts of less than a
window are kept whole; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, byte_texts, slices, small_or_plain, stage
from .tokens import mix, powers, window_hashes, word_hashes

WINDOW, ANCHOR = 50, 16
_BASES = (0xA0761D6478BD642F, 0xE7037ED1A0B428DB)
_PATH = "doc_id long, text_hash long, anchor long, label long, second long, start int, edges int"
_KEYS = ["doc_id", "text_hash"]


def leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the first least value in every window of ``width`` values."""
    count = len(values) - width + 1
    low, at, reach = values, np.arange(len(values)), 1
    while reach * 2 <= width:
        right = low[reach:] < low[:-reach]
        at = np.where(right, at[reach:], at[:-reach])
        low = np.where(right, low[reach:], low[:-reach])
        reach *= 2
    shift = width - reach
    right = low[shift:shift + count] < low[:count]
    return np.where(right, at[shift:shift + count], at[:count])


def _run_hashes(words: np.ndarray, starts: np.ndarray, stops: np.ndarray, base: int) -> np.ndarray:
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * powers(base, len(words)), out=sums[1:])
    return mix((sums[stops] - sums[starts]) * powers(pow(base, -1, 1 << 64), len(words))[starts])


def paths(words: np.ndarray, window: int = WINDOW, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """Local paths of a text: anchor, label, second label, first edge, number of edges."""
    if len(words) < window:
        return (words[:0],) * 3 + (np.zeros(0, np.int32),) * 2
    anchors = window_hashes(words, anchor)
    at = leftmost_least(anchors, window - anchor + 1)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    stop = np.append(first[1:], len(at))
    place = (at[first] - first).astype(np.uint64) << np.uint64(32) | (stop - first).astype(np.uint64)
    labels = [_run_hashes(words, first, stop + window - 1, b) for b in _BASES]
    return (anchors[at[first]], mix(labels[0] ^ place * np.uint64(_BASES[1])), labels[1],
            first.astype(np.int32), (stop - first).astype(np.int32))


def path_table(rows: DataFrame) -> DataFrame:
    """The local paths of all rows (doc_id, text_hash, text)."""

    def run(batches):
        for batch in slices(batches):
            found = [paths(word_hashes(t)) for t in byte_texts(batch.column("text"))]
            counts = [len(f[0]) for f in found]
            own = [np.repeat(batch.column(c).to_numpy(zero_copy_only=False), counts) for c in _KEYS]
            rest = [np.concatenate([f[i] for f in found]) for i in range(5)]
            rest[:3] = [c.view(np.int64) for c in rest[:3]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in own + rest], [*_KEYS, "anchor", "label", "second", "start", "edges"])

    return rows.mapInArrow(run, _PATH)


def _documents(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn(
        "text_hash", F.xxhash64("text"))


def _attach(rows: DataFrame, extra: DataFrame, n: int) -> DataFrame:
    """Rows inner-joined with ``extra``, ``n`` rows of one per key; others are dropped before the shuffle."""
    if n * 32 <= BROADCAST_BYTES:
        rows = rows.join(F.broadcast(extra.select(*_KEYS)), _KEYS, "left_semi")
    return rows.join(extra, _KEYS)


def _single_edges(rows: DataFrame, branching: DataFrame, n: int, window: int) -> DataFrame:
    """Every edge of the branching paths: two hashes of its words, document and first word."""

    def run(batches):
        for batch in slices(batches):
            out = []
            for doc, name, text, spans in zip(
                    *(batch.column(c).to_pylist() for c in _KEYS), byte_texts(batch.column("text")),
                    batch.column("spans").to_pylist(), strict=True):
                words = word_hashes(text)
                at = np.unique(np.concatenate([np.arange(s["start"], s["start"] + s["edges"]) for s in spans]))
                hashes = [window_hashes(words, window, b)[at].view(np.int64) for b in _BASES]
                out.append((np.full(len(at), doc), np.full(len(at), name), *hashes, at.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([o[i] for o in out])) for i in range(5)], [*_KEYS, "one", "two", "start"])

    return _attach(rows, branching, n).select(*_KEYS, "text", "spans").mapInArrow(
        run, "doc_id long, text_hash long, one long, two long, start int")


def covered_ranges(rows: DataFrame, window: int = WINDOW) -> DataFrame:
    """Word ranges (start, edges) of the windows that begin in a smaller document as well, per document."""
    known = rows.where(F.col("doc_id").isNotNull())
    found = stage(path_table(known), "substring-paths")
    repeated = stage(
        found.groupBy("anchor").agg(
            F.min("doc_id").alias("low"), F.max("doc_id").alias("high"),
            F.min("label").alias("l"), F.max("label").alias("m"))
        .where("low != high").select("anchor", (F.col("l") != F.col("m")).alias("branches")), "substring-anchors")
    shared = stage(found.join(small_or_plain(repeated, repeated.count(), 24), "anchor"), "substring-shared")
    source = shared.groupBy("anchor", "label").agg(F.min(F.struct("doc_id", "start", "second")).alias("source"))
    judged = shared.join(source, ["anchor", "label"])
    is_first = F.col("doc_id") == F.col("source.doc_id")
    agrees = F.col("second") == F.col("source.second")
    judged = stage(
        judged.select(*_KEYS, "start", "edges", "branches", (~is_first & agrees).alias("covered")).where(
            F.col("covered") | F.col("branches")).distinct(), "substring-judged")
    branching = stage(
        judged.where(~F.col("covered")).groupBy(*_KEYS).agg(
            F.collect_set(F.struct("start", "edges")).alias("spans")), "substring-branching")
    edges = stage(_single_edges(known, branching, branching.count(), window), "substring-edges")
    least = edges.groupBy("one", "two").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low != high")
    single = edges.join(least, ["one", "two"]).where("doc_id > low").select(
        *_KEYS, "start", F.lit(1).alias("edges"))
    whole = judged.where("covered").select(*_KEYS, "start", "edges")
    return stage(whole.unionByName(single).groupBy(*_KEYS).agg(
        F.collect_set(F.struct("start", "edges")).alias("spans")), "substring-ranges")


def _removed(n: int, spans: list[dict], window: int) -> np.ndarray:
    """Mask of the words that ranges of windows cover."""
    change = np.zeros(n + 1, np.int64)
    starts = np.array([s["start"] for s in spans], np.int64)
    stops = np.array([s["start"] + s["edges"] + window - 1 for s in spans], np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, stops, -1)
    return np.cumsum(change[:-1]) > 0


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Per row: doc_id, n_words, n_removed and kept (the words that stay, joined by one blank)."""
    rows = _documents(df, key, text)
    ranges = covered_ranges(rows, window)
    n = ranges.count()

    def run(batches):
        for batch in slices(batches):
            total, gone, kept = [], [], []
            spans = batch.column("spans").to_pylist() if "spans" in batch.schema.names else [None] * batch.num_rows
            for t, own in zip(byte_texts(batch.column("text")), spans, strict=True):
                words = t.split()
                total.append(len(words))
                if own:
                    mask = _removed(len(words), own, window)
                    words = [w for w, out in zip(words, mask.tolist(), strict=True) if not out]
                gone.append(total[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept"])

    schema = "doc_id long, n_words long, n_removed long, kept string"
    if n * 32 > BROADCAST_BYTES:
        return rows.join(ranges, _KEYS, "left").select("doc_id", "text", "spans").mapInArrow(run, schema)
    plain = rows.join(F.broadcast(ranges.select(*_KEYS)), _KEYS, "left_anti").select("doc_id", "text")
    cut = _attach(rows, ranges, n).select("doc_id", "text", "spans")
    return plain.mapInArrow(run, schema).unionByName(cut.mapInArrow(run, schema))


def report(df: DataFrame) -> DataFrame:
    """Per row: numbers of words and removed words, digest of the kept words."""
    return remove_repeats(df).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def substring_sql(window: int = WINDOW) -> str:
    """The same rows as a DuckDB statement, over all windows as text."""
    return f"""
      with w as (select row_number() over () as rid, doc_id,
          regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents),
      p as (select rid, doc_id, w, unnest(range(1, len(w) - {window - 2})) as p from w where len(w) >= {window}),
      g as (select rid, doc_id, p, md5(array_to_string(w[p:p + {window - 1}], ' ')) as g from p),
      r as (select rid, p from (select rid, p, doc_id, min(doc_id) over (partition by g) as low from g) where low < doc_id),
      c as (select distinct rid, unnest(range(p, p + {window})) as pos from r),
      s as (select rid, list(pos) as gone from c group by rid)
      select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(len(gone), 0) as bigint) as n_removed,
        sha256(coalesce(array_to_string(case when gone is null then w else
          list_transform(list_filter(range(1, len(w) + 1), lambda i: not list_contains(gone, i)), lambda i: w[i]) end, ' '), ''))
          as kept_sha256
      from w left join s using (rid)"""
