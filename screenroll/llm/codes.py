"""Vector codes: one codebook per part of the vectors, with LAESA pivots for exact assignment.

Components become integers, floor(SCALE * x), and every vector is cut into PARTS equal consecutive
parts. For each part a few of the first codebook's entries are fixed as pivots, far from each other,
and the distances of every part to its pivots are computed once and stored with it. A round knows
the distances of the entries to the pivots as well: the largest difference of two such distances is
a lower bound of the distance between part and entry. Entries are taken in the order of their
bounds, and an exact integer distance is computed only while the bound does not exceed the best
distance so far. Each task sums the parts of every entry; Spark adds the sums up, and the driver
holds one codebook (PARTS * ENTRIES entries), whatever the number of vectors.

Distances are exact: where components are so large that 64-bit sums could overflow, Python integers
are used. Bounds are floating-point numbers with a margin.

Defined results: rows whose vector is NULL or holds NULL or non-finite components are dropped, and
so are vectors of another length than the first kept row's (the smallest id's), and all if that length
is no multiple of PARTS. With fewer than ENTRIES rows the codebooks are shorter; equal ids are ordered
by vector, NULL ids come last; repeated rows are coded and counted each; no rows give an empty result.
A squared distance, or a sum of them, that does not fit a long is NULL; sums of components up to
10**60 are exact. Columns named like the result
are replaced, others of ``encode`` pass through.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_or_plain, stage

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
PIVOTS = 8
#: Exact distances computed at a time for each part that still has entries in reach.
STEP = 8
#: Components below this give exact 64-bit sums of squares for parts of up to 2**14 components.
_NARROW = 1 << 23
_MARGIN = 1e-9
_BASE = 10**24


def _whole(column: pa.Array) -> np.ndarray:
    """Rows of integer components: floor(SCALE * x), as 64-bit or else as Python integers."""
    flat = np.array(column.flatten().to_numpy(zero_copy_only=False), np.float64)
    rows = flat.reshape(len(column), len(flat) // max(len(column), 1))
    scaled = np.floor(rows * SCALE)
    if np.isfinite(scaled).all() and (np.abs(scaled) < _NARROW).all():
        return scaled.astype(np.int64)
    return np.array([[math.floor(int(v) * SCALE if abs(v) > 2.0**60 else v * SCALE) for v in r] for r in rows.tolist()],
                    object).reshape(rows.shape)


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances along the last axis."""
    d = a - b
    if d.dtype == object:
        return (d * d).sum(axis=-1)
    return np.einsum("...i,...i->...", d, d)


def _floats(values: np.ndarray) -> np.ndarray:
    """Integers as floating-point numbers, those beyond the range as infinite."""
    if values.dtype != object:
        return values.astype(np.float64)
    return np.array([float(v) if v < 1 << 1000 else math.inf for v in values.ravel().tolist()]).reshape(values.shape)


def _lengths(squares: np.ndarray) -> np.ndarray:
    return np.minimum(np.sqrt(_floats(squares)), 1e150)


@dataclass
class Codebooks:
    """Entries (part, entry, component) and pivots (part, pivot, component)."""

    entries: np.ndarray
    pivots: np.ndarray

    @property
    def size(self) -> int:
        """Components of a whole vector."""
        return self.entries.shape[0] * self.entries.shape[2]

    def digest(self) -> str:
        """SHA-256 of all components in order, comma-joined."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def pivot_distances(self, vectors: np.ndarray) -> np.ndarray:
        """Distances (row, part, pivot) of the parts of vectors."""
        parts = vectors.reshape(len(vectors), len(self.entries), 1, -1)
        return np.stack([_lengths(_squares(parts[:, p], self.pivots[p])) for p in range(len(self.entries))], axis=1)

    def assign(self, vectors: np.ndarray, distances: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry (row, part) and its squared distance; ties to the lower entry."""
        parts = vectors.reshape(len(vectors), len(self.entries), -1)
        found = [self._nearest(p, parts[:, p], distances[:, p]) for p in range(len(self.entries))]
        return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)

    def _nearest(self, part: int, x: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        entries = self.entries[part]
        to_pivots = _lengths(_squares(entries[:, None], self.pivots[part]))
        bound = np.zeros((len(x), len(entries)))
        for pivot in range(known.shape[1]):
            np.maximum(bound, np.abs(known[:, pivot, None] - to_pivots[:, pivot]), out=bound)
        # A margin for rounding keeps every bound below the true distance.
        bound -= _MARGIN * (known.max(axis=1, initial=1.0)[:, None] + to_pivots.max(initial=1.0))
        np.square(np.maximum(bound, 0.0, out=bound), out=bound)
        order = np.argsort(bound, axis=1, kind="stable")
        rows = np.arange(len(x))
        best = np.full(len(x), len(entries))
        least = np.zeros(len(x), np.result_type(x, entries))
        for at in range(0, len(entries), STEP):
            chosen = order[rows, at:at + STEP]
            if at:
                open_ = bound[rows, chosen[:, 0]] <= _floats(least[rows]) * (1 + _MARGIN)
                rows, chosen = rows[open_], chosen[open_]
                if not len(rows):
                    break
            exact = _squares(x[rows, None], entries[chosen])
            near = exact.min(axis=1)
            index = np.where(exact == near[:, None], chosen, len(entries)).min(axis=1)
            if not at:
                best[rows], least[rows] = index, near
                continue
            better = (near < least[rows]) | ((near == least[rows]) & (index < best[rows]))
            best[rows[better]], least[rows[better]] = index[better], near[better]
        return best, least

    def replaced(self, sums: dict[tuple[int, int], tuple[int, list[int]]]) -> Codebooks:
        """Entries moved to the floor of the mean of their parts; those without any stay."""
        entries = self.entries.astype(object)
        for (part, entry), (count, total) in sums.items():
            entries[part, entry] = [t // count for t in total]
        return Codebooks(_narrow(entries), self.pivots)


def _narrow(values: np.ndarray) -> np.ndarray:
    """64-bit integers where they are safe."""
    if all(abs(v) < _NARROW for v in values.ravel().tolist()):
        return values.astype(np.int64)
    return values.astype(object)


def _far_apart(entries: np.ndarray, n: int) -> np.ndarray:
    """``n`` entries, each the farthest from those before it."""
    chosen = [0]
    apart = _lengths(_squares(entries, entries[0]))
    while len(chosen) < min(n, len(entries)):
        chosen.append(int(apart.argmax()))
        apart = np.minimum(apart, _lengths(_squares(entries, entries[chosen[-1]])))
    return entries[chosen]


def _taking_part(df: DataFrame, vector: str) -> DataFrame:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != math.inf))
    return df.where(F.col(vector).isNotNull() & finite)


def first_codebooks(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> Codebooks | None:
    """The parts of the first ENTRIES rows by id; None without rows or if vectors cannot be cut. At most ENTRIES rows reach the driver."""
    first = _taking_part(df, vector).select(key, F.col(vector).cast("array<double>").alias(vector)).orderBy(
        F.col(key).asc_nulls_last(), vector)
    top = first.limit(1).toArrow()
    size = len(top.column(vector)[0]) if top.num_rows else 0
    if not top.num_rows or size % PARTS:
        return None
    rows = first.where(F.size(vector) == size).limit(ENTRIES).toArrow().column(vector).combine_chunks()
    vectors = _whole(rows).reshape(len(rows), PARTS, size // PARTS)
    entries = _narrow(vectors.transpose(1, 0, 2))
    return Codebooks(entries, np.stack([_far_apart(e, PIVOTS) for e in entries]))


def with_pivots(df: DataFrame, books: Codebooks, vector: str = "embedding") -> DataFrame:
    """The rows that can be coded, with the distances of their parts to the pivots; one narrow pass."""
    rows = _taking_part(df, vector).where(F.size(vector) == books.size).drop("pivots")
    schema = rows.withColumn("pivots", F.array().cast("array<double>")).schema

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            known = books.pivot_distances(_whole(batch.column(vector))).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(list(known), pa.list_(pa.float64()))], [*batch.schema.names, "pivots"])

    return rows.mapInArrow(run, schema)


def _assigned(batch, books: Codebooks, vector: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    vectors = _whole(batch.column(vector))
    known = batch.column("pivots").flatten().to_numpy().reshape(batch.num_rows, len(books.entries), -1)
    return vectors, *books.assign(vectors, known)


def _sums(rows: DataFrame, books: Codebooks, vector: str) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """Number and componentwise sum of the parts of every entry; sums are added up in the tasks first."""
    parts, entries, width = books.entries.shape

    def run(batches):
        counts, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), object)
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors, code, _ = _assigned(batch, books, vector)
            cut = vectors.reshape(len(vectors), parts, width)
            for p in range(parts):
                counts[p] += np.bincount(code[:, p], minlength=entries)
                part = np.zeros((entries, width), cut.dtype)
                np.add.at(part, code[:, p], cut[:, p])
                sums[p] += part
        used = np.argwhere(counts)
        # Sums may be wider than a long: two decimals each, the lower one below BASE.
        halves = [[str(h) for v in sums[p, e] for h in divmod(v, _BASE)] for p, e in used]
        yield pa.RecordBatch.from_arrays([
            pa.array(used[:, 0], pa.int32()), pa.array(used[:, 1], pa.int32()), pa.array(counts[tuple(used.T)]),
            pa.array(halves, pa.list_(pa.string()))], ["part", "entry", "n", "sums"])

    partial = rows.select(vector, "pivots").mapInArrow(run, "part int, entry int, n long, sums array<string>")
    total = partial.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), *[F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(2 * width)])
    return {(r["part"], r["entry"]): (r["n"], [int(a) * _BASE + int(b) for a, b in zip(r[3::2], r[4::2], strict=True)])
            for r in total.collect()}


def train(rows: DataFrame, books: Codebooks, rounds: int = ROUNDS, vector: str = "embedding") -> Codebooks:
    """Codebooks after some rounds over stored rows with pivot distances."""
    for _ in range(rounds):
        books = books.replaced(_sums(rows, books, vector))
    return books


def encode(rows: DataFrame, books: Codebooks, vector: str = "embedding") -> DataFrame:
    """Rows with pivot distances replaced by rows with ``code`` (two hex digits a part) and ``error``; one narrow pass."""
    rest = rows.drop("code", "error")
    kept = [c for c in rest.columns if c not in (vector, "pivots")]
    schema = rest.select(*kept, F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")).schema

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            _, code, squares = _assigned(batch, books, vector)
            digits = code.astype(np.uint8).tobytes().hex()
            wide = 2 * len(books.entries)
            error = [v if v < 1 << 63 else None for v in squares.astype(object).sum(axis=1).tolist()]
            yield pa.RecordBatch.from_arrays([
                *[batch.column(c) for c in kept],
                pa.array([digits[i:i + wide] for i in range(0, len(digits), wide)], pa.string()), pa.array(error, pa.int64())],
                [*kept, "code", "error"])

    return rest.mapInArrow(run, schema)


def decode(codes: DataFrame, books: Codebooks, code: str = "code", vector: str = "embedding") -> DataFrame:
    """Codes with the vectors that they stand for, as numbers; NULL codes give NULL."""
    rest = codes.drop(vector) if vector != code else codes
    schema = rest.withColumn(vector, F.array().cast("array<double>")).schema

    def run(batches):
        for batch in batches:
            out = []
            for text in batch.column(code).to_pylist():
                at = None if text is None else list(bytes.fromhex(text))
                out.append(None if at is None else np.concatenate(
                    [e[i] for e, i in zip(books.entries, at, strict=True)]).astype(float) / SCALE)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.float64()))], [*batch.schema.names, vector])

    return rest.mapInArrow(run, schema)


def _fitting(total: Column) -> Column:
    """A decimal sum as a long, NULL if it does not fit."""
    return F.when(total <= F.lit((1 << 63) - 1).cast("decimal(38,0)"), total).cast("long")


def report(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """One row per coded vector: code, error, the error of its label, digest of the codebooks."""
    kinds = {"code": "string", "error": "long", "label_error": "long", "codebooks_sha256": "string"}
    schema = embeddings.select(key, *[F.lit(None).cast(kind).alias(name) for name, kind in kinds.items()]).schema
    books = first_codebooks(embeddings, key, vector)
    if books is None:
        return embeddings.sparkSession.createDataFrame([], schema)
    rows = stage(with_pivots(embeddings.select(key, label, vector), books, vector), "codes-pivots")
    books = train(rows, books, vector=vector)
    coded = stage(encode(rows, books, vector), "codes-coded")
    # An error that does not fit a long makes its label's sum unknown.
    wide = F.max(F.col("error").isNull())
    totals = stage(coded.groupBy(F.col(label).alias("_label")).agg(
        F.when(~wide, _fitting(F.sum(F.col("error").cast("decimal(38,0)")))).alias("label_error")), "codes-labels")
    known = small_or_plain(totals, totals.count(), 64)
    return coded.join(known, F.col(label).eqNullSafe(F.col("_label")), "left").select(
        key, "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def codes_sql() -> str:
    """DuckDB SQL for ``report`` over ``embeddings``: all distances of every round."""
    ctes = [f"""
    kept as materialized (
        select vec_id, label, embedding, row_number() over (order by vec_id nulls last, embedding) as r from embeddings
        where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    components as (
        select r, len(embedding) // {PARTS} as width, unnest(range(len(embedding))) as place, unnest(embedding)::double as x from kept),
    parts as materialized (
        select r, place // width as part, place % width as pos, floor({SCALE} * x)::bigint as v from components),
    book0 as materialized (select part, r - 1 as entry, pos, v from parts where r <= {ENTRIES})"""]
    for k in range(ROUNDS + 1):
        ctes.append(f"""
    near{k} as materialized (
        select r, part, min({{'d': d, 'entry': entry}}) as best from (
            select r, p.part, entry, sum((p.v - b.v) * (p.v - b.v))::bigint as d
            from parts p join book{k} b on p.part = b.part and p.pos = b.pos group by all)
        group by all)""")
        if k < ROUNDS:
            ctes.append(f"""
    moved{k} as (
        select p.part, best.entry as entry, pos, sum(v)::bigint as s, count(*) as c
        from parts p join near{k} n on p.r = n.r and p.part = n.part group by all),
    book{k + 1} as materialized (
        select b.part, b.entry, b.pos, coalesce((s - ((s % c) + c) % c) // c, b.v) as v
        from book{k} b left join moved{k} m on b.part = m.part and b.entry = m.entry and b.pos = m.pos)""")
    return f"""
    with {",".join(ctes)},
    coded as (
        select r, string_agg(printf('%02x', best.entry), '' order by part) as code, sum(best.d)::bigint as error
        from near{ROUNDS} group by r)
    select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error,
        (select sha256(string_agg(v::varchar, ',' order by part, entry, pos)) from book{ROUNDS}) as codebooks_sha256
    from coded join kept using (r)"""
