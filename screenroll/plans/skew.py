"""Finding keys that hold too many rows, or give too many, for one task.

Nothing here changes a result: the operators give the same rows whatever the
heavy keys are. It only decides which keys get the spread-out plan. Heavy keys
and splits are tables in the shared folder that are joined; the driver learns
how many rows they have, nothing else.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..schemas import KEY
from .shared import small, stored

#: About the bytes of a row of these tables in memory.
_ROW_BYTES = 100


@dataclass(frozen=True)
class SkewPolicy:
    """``rows_per_task``: rows, read or made, beyond which a key is spread over tasks."""

    rows_per_task: int = 2_000_000


DEFAULT_POLICY = SkewPolicy()
#: For tables that are known to have no heavy key: nothing is counted.
NO_SKEW = SkewPolicy(rows_per_task=1 << 62)


@dataclass(frozen=True)
class Keys:
    """Distinct keys as a stored table of one column ``_key``, with their rows ``_n``; ``most`` is the greatest of these."""

    rows: DataFrame
    count: int
    most: int

    def _table(self) -> DataFrame:
        return small(self.rows.select("_key"), self.count, _ROW_BYTES)

    def of(self, df: DataFrame, key: str) -> DataFrame:
        """Rows of these keys."""
        return df.join(self._table(), F.col(key).cast("string") == F.col("_key"), "left_semi")

    def others(self, df: DataFrame, key: str) -> DataFrame:
        """Rows of all other keys, and those without a key."""
        return df.join(self._table(), F.col(key).cast("string") == F.col("_key"), "left_anti")


@dataclass(frozen=True)
class Splits:
    """Keys to spread: a table (``_heavy`` key, ``_spread`` frame to divide, ``_parts``), and rows of it per frame."""

    rows: DataFrame
    counts: dict[str, int]

    def table(self) -> DataFrame:
        return small(self.rows, sum(self.counts.values()), _ROW_BYTES)


@dataclass(frozen=True)
class Heavy:
    """What one count of the keys of several frames found.

    ``rows`` is a stored table (``k``, ``n0``, ``n1``, ..) of the keys that are heavy in a frame or
    by the product of the ``joined`` frames. The fact ``light<i>`` is the number of rows of all other
    keys in frame i.
    """

    rows: DataFrame | None
    frames: tuple[str, ...]
    facts: dict[str, int]
    policy: SkewPolicy

    def keys(self, frame: str) -> Keys | None:
        """Keys with more rows in a frame than a task should have; None if there are none."""
        i = self.frames.index(frame)
        if not self.facts[f"h{i}"]:
            return None
        n = F.col(f"n{i}")
        rows = self.rows.where(n > self.policy.rows_per_task).select(F.col("k").alias("_key"), n.alias("_n"))
        return Keys(rows, self.facts[f"h{i}"], self.facts[f"m{i}"])

    def products(self) -> Keys | None:
        """Keys whose join gives too many rows; None if there are none."""
        if not self.facts["products"]:
            return None
        rows = self.rows.where("product").select(F.col("k").alias("_key"), F.lit(0).cast("long").alias("_n"))
        return Keys(rows, self.facts["products"], 0)


def _counts(frames: dict[str, DataFrame], key: str) -> DataFrame:
    """Exact rows of every key in each frame: one column per frame, one row per key.

    Rows are added up in each task first, so a hot key sends one row per task and frame.
    """
    keys = reduce(
        DataFrame.unionByName,
        [
            df.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("k"), F.lit(i).alias("f"))
            for i, df in enumerate(frames.values())
        ],
    )
    return keys.groupBy("k").agg(
        *[F.count(F.when(F.col("f") == i, 1)).alias(f"n{i}") for i in range(len(frames))]
    )


def _weight(numbers: list[int]) -> Column:
    """Rows that a join of these frames has for a key, at least those that come in."""
    counts = [F.col(f"n{i}").cast("double") for i in numbers]
    product = reduce(lambda a, b: a * b, [F.greatest(c, F.lit(1.0)) for c in counts])
    return F.greatest(product, reduce(lambda a, b: a + b, counts))


def heavy_keys(
    frames: dict[str, DataFrame],
    policy: SkewPolicy = DEFAULT_POLICY,
    key: str = KEY,
    joined: list[str] | None = None,
) -> Heavy:
    """Keys with too many rows in a frame, or in the join of the ``joined`` frames (all by default).

    The rows of every key are counted exactly, in one pass over the key columns.
    """
    names = tuple(frames)
    if policy == NO_SKEW:
        return Heavy(None, names, defaultdict(int), policy)
    some = [F.col(f"n{i}") > policy.rows_per_task for i in range(len(names))]
    weight = _weight([names.index(n) for n in (names if joined is None else joined)])
    counted = _counts(frames, key).withColumn("product", weight > policy.rows_per_task)
    is_heavy, light = reduce(lambda a, b: a | b, [*some, F.col("product")]), Observation()
    counted = counted.observe(
        light, *[F.sum(F.when(~is_heavy, F.col(f"n{i}"))).alias(f"light{i}") for i in range(len(names))])
    rows, facts = stored(
        counted.where(is_heavy), "heavy",
        products=F.count_if("product"),
        **{f"h{i}": F.count_if(one) for i, one in enumerate(some)},
        **{f"m{i}": F.max(f"n{i}") for i in range(len(names))},
    )
    return Heavy(rows, names, facts | {k: v or 0 for k, v in light.get.items()}, policy)


def split_counts(
    frames: dict[str, DataFrame],
    policy: SkewPolicy = DEFAULT_POLICY,
    key: str = KEY,
    heavy: Heavy | None = None,
) -> Splits | None:
    """For each key whose join gives too many rows, the frame to divide and into how many parts.

    The join of a key has as many rows as the product of its rows in all frames. ``heavy`` was found
    in tables that are cheap to count and give no fewer rows; only its keys are then counted on the
    frames. The frame with most rows of a key is divided, into at most as many parts as it has rows.
    None if there is nothing to spread.
    """
    if policy == NO_SKEW:
        return None
    if heavy is not None:
        picked = heavy.products()
        if picked is None:
            return None
        frames = {name: picked.of(df, key) for name, df in frames.items()}
    names = list(frames)
    weight = _weight(list(range(len(names))))
    largest = F.array_max(F.array(*[
        F.struct(F.col(f"n{i}").alias("n"), F.lit(name).alias("name")) for i, name in enumerate(names)
    ]))
    parts = F.least(F.ceil(weight / policy.rows_per_task), F.col("_most.n"), F.lit((1 << 31) - 1)).cast("int")
    chosen = (
        _counts(frames, key)
        .where(weight > policy.rows_per_task)
        .withColumn("_most", largest)
        .select(F.col("k").alias("_heavy"), F.col("_most.name").alias("_spread"), parts.alias("_parts"))
        .where("_parts > 1")
    )
    rows, facts = stored(
        chosen, "splits", **{f"c{i}": F.count_if(F.col("_spread") == name) for i, name in enumerate(names)})
    counts = {name: facts[f"c{i}"] for i, name in enumerate(names) if facts[f"c{i}"]}
    return Splits(rows, counts) if counts else None
