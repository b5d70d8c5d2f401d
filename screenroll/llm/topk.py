"""Exact inner-product search with a pivot-distance index.

Vectors are lifted by one coordinate so that the largest inner product becomes the smallest
distance. Every vector is keyed by its nearest pivot and its distance to it; sorted by that key,
vectors are cut into blocks, each an annulus [dmin, dmax] of one pivot. For a block of queries
the annuli are sorted by the distance they can come to at least (triangle inequality). The first
few are searched, which gives every query a score to beat. From there the sorted annuli are
followed up to the first one whose bound cannot reach the least score to beat of the query block:
the search stops there, before any vector of the others is read. The result is exact: bounds carry
a margin above rounding, and scores are integers.

The index is a range-partitioned table, in the order of pivot, distance and vector and then of the
place of the row: a vector that fills a third of the table is cut into as many blocks as it needs
and is no hot key. To the driver come a bounded sample for the pivots and two numbers. Queries are
joined to annuli by pivot (numbers only), then to the blocks; query blocks are broadcast behind a
check of their size, else shuffled.

Vectors with a component beyond +-2**26 (``LIMIT``) are wide: distances of doubles would not bound their
scores. They lie in blocks of their own, which are always searched, in exact integers of any size.

Defined results: rows whose id or vector is NULL, or whose vector holds NULL or a non-finite
component, take no part; shorter vectors count as padded with zeros; a component is floor(256 * x);
a score beyond a long counts as the end of its range; every row is a candidate, repeated ones as often
as they occur, and repeated rows or different vectors of a query's id are ranked together; with fewer
than k candidates all are returned; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small_or_plain, stage

PIVOTS, SAMPLE = 16, 2048
BLOCK, QUERY_BLOCK = 1024, 256
FIRST = 4
MARGIN = 1e-6
LIMIT = 1 << 26
WIDE = -1
_LONG = np.iinfo(np.int64)
_BLOCK = ("block long, pivot int, dmin double, dmax double, rows int, width int, ids binary, vectors binary")


def integer_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Rows that take part: id, packed components, squared length.

    Components are 32-bit integers floor(256 * x); of wide vectors, x itself as doubles and no length.
    """

    def run(batches):
        for batch in batches:
            ids, vectors, squares = [], [], []
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if i is None or not v.is_valid or v.values.null_count:
                    continue
                x = v.values.to_numpy(zero_copy_only=False).astype(float)
                if not np.isfinite(x).all():
                    continue
                ids.append(i)
                if np.abs(x).max(initial=0) > LIMIT / 256:
                    vectors.append(x.astype("<f8").tobytes())
                    squares.append(None)
                    continue
                whole = np.floor(256 * x)
                vectors.append(whole.astype("<i4").tobytes())
                squares.append(float(np.dot(whole, whole)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(vectors, pa.binary()), pa.array(squares, pa.float64())],
                ["id", "v", "square"])

    return df.select(F.col(key).cast("long"), vector).mapInArrow(run, "id long, v binary, square double")


def _matrix(packed: list[bytes], kind: str = "<i4") -> np.ndarray:
    size = np.dtype(kind).itemsize
    out = np.zeros((len(packed), max([len(b) // size for b in packed], default=0)))
    for row, b in zip(out, packed, strict=True):
        x = np.frombuffer(b, kind)
        row[:len(x)] = x
    return out


def _kind(pivot: int) -> str:
    """How the components of a block are packed."""
    return "<f8" if pivot == WIDE else "<i4"


def _integers(data: bytes, rows: int, width: int, pivot: int) -> np.ndarray:
    """The components of a block; those of wide vectors as Python integers."""
    x = np.frombuffer(data, _kind(pivot)).reshape(rows, width)
    if pivot != WIDE:
        return x
    whole = [int(c) * 256 if abs(c) >= 2 ** 53 else math.floor(c * 256) for c in x.ravel().tolist()]
    out = np.empty(len(whole), object)
    out[:] = whole
    return out.reshape(rows, width)


def _largest(x: np.ndarray) -> int:
    return max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows, exact, as longs."""
    bound = max(_largest(a), 1) * max(_largest(b), 1) * max(a.shape[1], 1)
    if bound < 2 ** 53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    if bound <= _LONG.max:
        return a.astype(np.int64) @ b.astype(np.int64).T
    return np.clip(a.astype(object) @ b.astype(object).T, int(_LONG.min), int(_LONG.max)).astype(np.int64)


class Pivots:
    """Pivot vectors and distances to them in the lifted space."""

    def __init__(self, vectors: np.ndarray, top: float):
        self.top, self.vectors = top, vectors
        self.height = np.sqrt(np.maximum(top - (vectors ** 2).sum(1), 0))

    def distances(self, x: np.ndarray, lifted: bool) -> np.ndarray:
        """Distances of rows to every pivot; queries are not lifted."""
        width = max(x.shape[1], self.vectors.shape[1])
        p = np.pad(self.vectors, ((0, 0), (0, width - self.vectors.shape[1])))
        x = np.pad(x, ((0, 0), (0, width - x.shape[1])))
        square = (x ** 2).sum(1)
        height = np.sqrt(np.maximum(self.top - square, 0)) if lifted else np.zeros(len(x))
        d = square[:, None] + height[:, None] ** 2 + self.top - 2 * (x @ p.T + height[:, None] * self.height)
        return np.sqrt(np.maximum(d, 0))


def choose_pivots(vectors: DataFrame, pivots: int = PIVOTS, sample: int = SAMPLE) -> Pivots | None:
    """Far-apart vectors of a bounded sample (the rows with the smallest hashes)."""
    rows, top = vectors.agg(F.count("*"), F.max("square")).collect()[0]
    if not rows:
        return None
    if top is None:
        return Pivots(np.zeros((1, 1)), 0.0)
    usual = vectors.where(F.col("square").isNotNull())
    x = _matrix([r["v"] for r in usual.orderBy(F.xxhash64("id"), "id").select("v").limit(sample).collect()])
    chosen, far = [0], np.full(len(x), np.inf)
    while len(chosen) < min(pivots, len(x)):
        far = np.minimum(far, Pivots(x[chosen[-1:]], top).distances(x, True)[:, 0])
        if far.max() <= 0:
            break
        chosen.append(int(far.argmax()))
    return Pivots(x[chosen], top)


def _blocks(rows: DataFrame, block: int, one_pivot: bool) -> DataFrame:
    """Sorted rows (pivot, distance, id, v) cut into blocks, of one pivot or of all but the wide rows."""

    def packed(number, held):
        ids, kind = [h[2] for h in held], _kind(held[0][0])
        vectors = _matrix([h[3] for h in held], kind)
        return (number, held[0][0], held[0][1], held[-1][1], len(held), vectors.shape[1],
                np.array(ids, "<i8").tobytes(), vectors.astype(kind).tobytes())

    def run(batches):
        number, held = TaskContext.get().partitionId() << 32, []
        names = [f.split()[0] for f in _BLOCK.split(", ")]
        kinds = [pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]

        def batch_of(row):
            return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(row, kinds, strict=True)], names)

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("pivot", "distance", "id", "v")), strict=True):
                apart = one_pivot or WIDE in (row[0], held[0][0] if held else row[0])
                if len(held) == block or held and apart and row[0] != held[0][0]:
                    yield batch_of(packed(number, held))
                    number, held = number + 1, []
                held.append(row)
        if held:
            yield batch_of(packed(number, held))

    keys = ["pivot", "distance", "id", "v", "place"]
    placed = rows.withColumn("place", F.monotonically_increasing_id())
    return placed.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(run, _BLOCK)


def _keyed(vectors: DataFrame, pivots: Pivots, lifted: bool) -> DataFrame:
    def run(batches):
        for batch in batches:
            wide = batch.column("square").is_null().to_numpy(zero_copy_only=False)
            packed = [b"" if w else v for v, w in zip(batch.column("v").to_pylist(), wide, strict=True)]
            d = pivots.distances(_matrix(packed), lifted)
            nearest = d.argmin(1) if len(d) else np.zeros(0, int)
            least = np.where(wide, 0.0, d[np.arange(len(d)), nearest])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.where(wide, WIDE, nearest).astype(np.int32)), pa.array(least),
                 batch.column("id"), batch.column("v")], ["pivot", "distance", "id", "v"])

    return vectors.mapInArrow(run, "pivot int, distance double, id long, v binary")


def build_index(vectors: DataFrame, pivots: Pivots) -> DataFrame:
    """The stored blocks of all vectors."""
    return stage(_blocks(_keyed(vectors, pivots, True), BLOCK, True), "topk-index")


def _reach(queries: DataFrame, pivots: Pivots) -> DataFrame:
    """Per query block and pivot the range of the queries' distances; per block its largest squared length.

    Wide queries reach every block, and every query reaches the blocks of wide vectors: NULL.
    """

    def run(batches):
        for batch in batches:
            for number, pivot, rows, width, data in zip(
                    *(batch.column(c).to_pylist() for c in ("block", "pivot", "rows", "width", "vectors")), strict=True):
                n = len(pivots.vectors)
                near, far, square = [None] * (n + 1), [None] * (n + 1), None
                if pivot != WIDE:
                    q = np.frombuffer(data, "<i4").reshape(rows, width).astype(float)
                    d = pivots.distances(q, False)
                    near[1:], far[1:], square = d.min(0).tolist(), d.max(0).tolist(), float((q ** 2).sum(1).max())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number] * (n + 1)), pa.array([rows] * (n + 1), pa.int32()),
                     pa.array(range(WIDE, n), pa.int32()), pa.array(near, pa.float64()), pa.array(far, pa.float64()),
                     pa.array([square] * (n + 1), pa.float64())],
                    ["queries", "query_rows", "pivot", "near", "far", "square"])

    return queries.mapInArrow(
        run, "queries long, query_rows int, pivot int, near double, far double, square double")


def _search(pairs: DataFrame, queries: DataFrame, blocks: DataFrame, pivots: Pivots, k: int) -> DataFrame:
    """Best k of each pair of blocks (queries, block, floors); floors: known k-th scores by query row."""

    def run(batches):
        names = ["queries", "query_row", "query_id", "vec_id", "score"]
        for batch in batches:
            for row in batch.to_pylist():
                q = _integers(row["q_vectors"], row["q_rows"], row["q_width"], row["q_pivot"])
                x = _integers(row["vectors"], row["rows"], row["width"], row["pivot"])
                width = min(q.shape[1], x.shape[1])
                q_ids, ids = np.frombuffer(row["q_ids"], "<i8"), np.frombuffer(row["ids"], "<i8")
                floor = np.full(len(q), _LONG.min)
                for known in row["floors"] or ():
                    floor[known["query_row"]] = known["floor"]
                use = np.arange(len(q))
                if WIDE not in (row["q_pivot"], row["pivot"]):
                    d = pivots.distances(q.astype(float), False)[:, row["pivot"]]
                    low = np.maximum(np.maximum(d - row["dmax"], row["dmin"] - d), 0) * (1 - MARGIN)
                    reach = (q.astype(float) ** 2).sum(1) + pivots.top
                    use = np.flatnonzero((reach - low ** 2) / 2 + reach * MARGIN + 1 >= floor)
                if not len(use) or not len(x):
                    continue
                scores = _products(q[use, :width], x[:, :width])
                out = [[], [], [], []]
                for r, own in zip(use, scores, strict=True):
                    keep = np.flatnonzero((own >= floor[r]) & (ids != q_ids[r]))
                    keep = keep[np.lexsort((ids[keep], ~own[keep]))[:k]]
                    out[0].append(np.full(len(keep), r))
                    out[1].append(np.full(len(keep), q_ids[r]))
                    out[2].append(ids[keep])
                    out[3].append(own[keep])
                rows, qs, vs, ss = (np.concatenate(c).astype(np.int64) for c in out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), row["queries"])), pa.array(rows.astype(np.int32)),
                     pa.array(qs), pa.array(vs), pa.array(ss)], names)

    own = queries.select(
        F.col("block").alias("queries"), F.col("pivot").alias("q_pivot"), F.col("rows").alias("q_rows"),
        F.col("width").alias("q_width"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"))
    both = pairs.join(blocks, "block").join(own, "queries")
    return both.mapInArrow(run, "queries long, query_row int, query_id long, vec_id long, score long")


def block_pairs(packed: DataFrame, blocks: DataFrame, pivots: Pivots) -> DataFrame:
    """Per query block the annuli in the order of their bounds (``turn``), with the best score they allow (NULL: any)."""
    annuli = blocks.select("block", "pivot", "dmin", "dmax")
    wide = F.col("near").isNull()
    bound = F.when(wide, 0.0).otherwise(
        F.greatest(F.col("near") - F.col("dmax"), F.col("dmin") - F.col("far"), F.lit(0.0)))
    low = F.col("bound") * (1 - MARGIN)
    reach = F.col("square") + pivots.top
    pairs = (
        _reach(packed, pivots).join(annuli, "pivot").withColumn("bound", bound)
        .withColumn("best", F.when(~wide, (reach - low * low) / 2 + reach * MARGIN + 1)))
    order = Window.partitionBy("queries").orderBy("bound", "block")
    return pairs.select(
        "queries", "query_rows", "block", "bound", "best", F.row_number().over(order).alias("turn"))


def still_open(pairs: DataFrame, first: DataFrame, k: int) -> DataFrame:
    """Annuli after the first ones that can hold a better row for some query of the block, with the scores to beat."""
    rank = Window.partitionBy("queries", "query_row").orderBy(F.desc("score"), "vec_id")
    floors = (
        first.withColumn("n", F.row_number().over(rank)).where(F.col("n") == k).groupBy("queries")
        .agg(F.collect_list(F.struct("query_row", F.col("score").alias("floor"))).alias("floors"),
             F.min("score").alias("least"), F.count("*").alias("known")))
    rest = pairs.where(F.col("turn") > FIRST).join(floors, "queries", "left")
    hopeless = (F.col("known") == F.col("query_rows")) & (F.col("best") < F.col("least"))
    return rest.where(~F.coalesce(hopeless, F.lit(False))).select("queries", "block", "floors")


def search(queries: DataFrame, pivots: Pivots, blocks: DataFrame, k: int) -> DataFrame:
    """The k best of ``blocks`` for every query vector, other than vectors of its own id."""
    packed = stage(_blocks(_keyed(queries, pivots, False), QUERY_BLOCK, False), "topk-queries")
    size = packed.agg(F.count("*"), F.max(F.octet_length("vectors"))).collect()[0]
    near = small_or_plain(packed, size[0], (size[1] or 0) + 4096)
    pairs = stage(block_pairs(packed, blocks, pivots), "topk-pairs")
    none = F.lit(None).cast("array<struct<query_row:int,floor:long>>")
    start = pairs.where(F.col("turn") <= FIRST).select("queries", "block", none.alias("floors"))
    first = stage(_search(start, near, blocks, pivots, k), "topk-first")
    found = first.unionByName(_search(still_open(pairs, first, k), near, blocks, pivots, k))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def report(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = 50, k: int = 5) -> DataFrame:
    """The k best vectors for every row whose id is divisible by ``every``."""
    vectors = stage(integer_vectors(embeddings, key, vector), "topk-vectors")
    pivots = choose_pivots(vectors)
    if pivots is None:
        return embeddings.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    blocks = build_index(vectors, pivots)
    return search(vectors.where(F.col("id") % every == 0), pivots, blocks, k)


def topk_sql(every: int = 50, k: int = 5) -> str:
    """The same rows as a DuckDB statement."""
    return f"""
      with v as (select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
        from embeddings where vec_id is not null and embedding is not null
          and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
      s as (select q.vec_id as query_id, c.vec_id,
          cast(coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: coalesce(p[1] * p[2], 0))), 0) as bigint) as score
        from v q, v c where q.vec_id % {every} = 0 and c.vec_id <> q.vec_id)
      select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank,
        vec_id, score
      from s qualify rank <= {k}"""
