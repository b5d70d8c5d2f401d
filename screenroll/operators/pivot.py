"""Spreading the ranked rows of an entity over numbered columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fit, partial_date, safe_date
from ..schemas import KEY, NATIONAL_ID_PREFIX


def slot_pivot(
    df: DataFrame,
    key: str,
    order: list[Column],
    values: dict[str, str],
    n: int,
    extra: list[Column] | None = None,
) -> DataFrame:
    """One row per key with the first ``n`` rows in columns.

    ``values`` maps a source column to a name pattern with ``{i}``. Each task
    passes on at most ``n`` rows per key; ranking and pivot share one shuffle.
    ``extra`` are further aggregates over the kept rows.
    """
    by_key = Window.partitionBy(key).orderBy(*order)
    top = df.withColumn("_slot", F.row_number().over(by_key)).where(F.col("_slot") <= n)
    return top.groupBy(key).agg(
        *[
            F.max(F.when(F.col("_slot") == i, F.col(c))).alias(name.format(i=i))
            for i in range(1, n + 1)
            for c, name in values.items()
        ],
        *(extra or []),
    )


def format_birth_dates(dob: DataFrame, order: str = "text", null_parts: str = "null") -> DataFrame:
    """Last birth date as text and the three before it as timestamps.

    ``order="text"`` ranks the unpadded texts as they are, ``"date"`` ranks
    real dates first, by date.
    """
    if order not in ("text", "date"):
        raise ValueError(f"unknown order {order!r}")
    text = partial_date(F.col("BirthYear"), F.col("BirthMonth"), F.col("BirthDay"), null_parts)
    texts = dob.where(F.col(KEY).isNotNull()).select(KEY, text.alias("_dob")).distinct()
    ranking = [F.col("_dob").desc_nulls_last()]
    if order == "date":
        ranking.insert(0, safe_date(F.col("_dob")).desc_nulls_last())
    slots = slot_pivot(texts, KEY, ranking, {"_dob": "_dob{i}"}, 4)

    def alternative(i: int) -> Column:
        value = F.col(f"_dob{i}")
        return safe_date(F.when(F.length(F.rtrim(value)) > 7, value)).alias(f"ALTDOB{i - 1}")

    return slots.select(KEY, F.col("_dob1").alias("DOB"), *[alternative(i) for i in (2, 3, 4)])


def pivot_other_ids(ident: DataFrame) -> DataFrame:
    """First five ids of each entity that has no national id.

    National ids sort first, so one among the kept rows tells that the entity
    has one; no join is needed to leave such entities out.
    """
    national = F.col("IdentificationTypeDesc").startswith(NATIONAL_ID_PREFIX)
    ids = ident.where(F.col(KEY).isNotNull()).select(
        KEY,
        fit(F.col("IdentificationTypeDesc").cast("string"), 85).alias("_type"),
        fit(F.col("IdentificationNumber"), 50).alias("_number"),
        F.coalesce(national, F.lit(False)).alias("_national"),
    )
    order = [
        F.col("_national").desc(), F.col("_number").desc_nulls_last(),
        F.col("_type").asc_nulls_last(),
    ]
    slots = slot_pivot(
        ids, KEY, order, {"_type": "IdOtherInfo{i}", "_number": "IdNo{i}"}, 5,
        extra=[F.max("_national").alias("_hidden")],
    )
    return slots.where(~F.col("_hidden")).drop("_hidden")
