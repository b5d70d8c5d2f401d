"""Left joins of one hub with many satellites on the same key.

All joins use one key, so each input is shuffled once and the joins then run
side by side in one stage; the wide rows are never shuffled again.

A key that is too heavy for one task is spread over salts: the rows of its
largest satellite are divided among the salts, the hub row and the rows of the
other satellites are repeated for every salt. Equal rows of the divided
satellite are counted before the shuffle and travel as one row with a number
of copies, so a large group of copies costs no more than one row per salt.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import KEY
from .skew import Splits

HUB = "hub"
_SALT, _COPIES, _HIT, _SPREAD, _PARTS = "_salt", "_copies", "_hit", "_spread", "_parts"
_CHUNK = 10_000


@dataclass(frozen=True)
class Satellite:
    """Rows to be joined to the hub.

    ``only_with`` names a boolean column of an earlier satellite: the rows are
    joined only where it is true. ``source`` has about the same keys and is
    cheaper to look for heavy keys in.
    """

    name: str
    rows: DataFrame
    only_with: str | None = None
    source: DataFrame | None = None


def star_join(
    hub: DataFrame,
    satellites: list[Satellite],
    splits: Splits | None = None,
    key: str = KEY,
) -> DataFrame:
    """Hub left-joined with every satellite, as a bag.

    ``splits`` names the keys to spread and the satellite (or ``hub``) to
    divide for each; a key appears at most once.
    """
    if not splits:
        out = hub
        for sat in satellites:
            out = _left_join(out, sat.rows, [key], sat.only_with)
        return out

    out = _salted(HUB, hub, splits, key)
    # The hub keeps its key's spread name, to tell empty salts from missing rows.
    for sat in satellites:
        rows = _salted(sat.name, sat.rows, splits, key).drop(_SPREAD)
        if sat.name not in splits.counts:
            out = _left_join(out, rows.drop(_COPIES), [key, _SALT], sat.only_with)
            continue
        rows = rows.withColumnRenamed(_COPIES, "_more").withColumn(_HIT, F.lit(True))
        out = _left_join(out, rows, [key, _SALT], sat.only_with)
        wanted = F.coalesce(F.col(_SPREAD) != sat.name, F.lit(True)) | F.col(_HIT).isNotNull()
        if sat.only_with:
            wanted |= F.col(sat.only_with).isNull() & (F.col(_SALT) == 0)
        out = (
            out.where(wanted)
            .withColumn(_COPIES, F.col(_COPIES) * F.coalesce("_more", F.lit(1)))
            .drop("_more", _HIT)
        )
    return _repeat(out).drop(_SALT, _SPREAD)


def _left_join(left: DataFrame, right: DataFrame, on: list[str], only_with: str | None):
    if not only_with:
        return left.join(right, on, "left")
    for c in on:
        right = right.withColumnRenamed(c, f"_right{c}")
    condition = F.col(only_with)
    for c in on:
        condition &= F.col(c) == F.col(f"_right{c}")
    return left.join(right, condition, "left").drop(*[f"_right{c}" for c in on])


def _salted(name: str, rows: DataFrame, splits: Splits, key: str) -> DataFrame:
    """Rows with a salt, a number of copies and the spread name of their key."""
    table = splits.table()
    tagged = rows.join(table, F.col(key) == F.col("_heavy"), "left").drop("_heavy")
    repeated = (
        tagged.where(F.col(_SPREAD).isNull() | (F.col(_SPREAD) != name))
        .withColumn(
            _SALT,
            F.explode(
                F.when(F.col(_PARTS).isNull(), F.array(F.lit(0))).otherwise(
                    F.sequence(F.lit(0), F.col(_PARTS) - 1)
                )
            ),
        )
        .withColumn(_COPIES, F.lit(1).cast("long"))
        .drop(_PARTS)
    )
    if name not in splits.counts:
        return repeated
    parts, copies = F.col(_PARTS), F.col(_COPIES)
    divided = (
        tagged.where(F.col(_SPREAD) == name)
        .groupBy(*rows.columns, _SPREAD, _PARTS)
        .agg(F.count("*").alias(_COPIES))
        .withColumn("_start", F.pmod(F.xxhash64(*rows.columns), parts).cast("int"))
        .withColumn(
            "_share",
            F.explode(
                F.transform(
                    F.sequence(F.lit(0), (F.least(copies, parts.cast("long")) - 1).cast("int")),
                    lambda i: F.struct(
                        F.pmod(F.col("_start") + i, parts).alias(_SALT),
                        (
                            F.expr(f"{_COPIES} div {_PARTS}")
                            + F.when(i < F.pmod(copies, parts), 1).otherwise(0)
                        ).alias(_COPIES),
                    ),
                )
            ),
        )
        .select(
            *rows.columns, _SPREAD, F.col(f"_share.{_SALT}").alias(_SALT),
            F.col(f"_share.{_COPIES}").alias(_COPIES),
        )
    )
    return repeated.unionByName(divided)


def _repeat(df: DataFrame) -> DataFrame:
    """Emit each row ``_copies`` times, in chunks so that no array grows large."""
    chunks = F.sequence(F.lit(0).cast("long"), F.expr(f"(_copies - 1) div {_CHUNK}"))
    in_chunk = F.least(F.lit(_CHUNK), F.col(_COPIES) - F.col("_chunk") * _CHUNK).cast("int")
    return (
        df.withColumn("_chunk", F.explode(chunks))
        .withColumn("_one", F.explode(F.sequence(F.lit(1), in_chunk)))
        .drop("_chunk", "_one", _COPIES)
    )
