"""Best address, birth place and country name of an entity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fit, visible_length
from ..plans.shared import small
from ..plans.skew import DEFAULT_POLICY, Keys, SkewPolicy, heavy_keys, split_counts
from ..plans.star import HUB, Satellite, star_join
from ..schemas import BIRTH_PLACE, KEY


def best_by_length(
    df: DataFrame,
    key: str,
    columns: list[str],
    ties: str = "all",
    heavy: Keys | None = None,
) -> DataFrame:
    """Rows of each key with the most text in ``columns``.

    ``ties="all"`` keeps every row of the greatest length, ``"one"`` a single
    one (least in column order). The window limits each key before the
    shuffle. The greatest lengths of the ``heavy`` keys, one row each, are sent
    to their rows, which are not shuffled at all while those are few.
    """
    if ties not in ("all", "one"):
        raise ValueError(f"unknown ties {ties!r}")
    length = sum((visible_length(F.col(c)) for c in columns[1:]), visible_length(F.col(columns[0])))
    rows = df.where(F.col(key).isNotNull()).withColumn("_length", length)
    by_length = F.col("_length").desc()

    if ties == "one":
        order = Window.partitionBy(key).orderBy(
            by_length, *[F.col(c).asc_nulls_last() for c in columns]
        )
        best = rows.withColumn("_nth", F.row_number().over(order)).where(F.col("_nth") == 1)
        return best.drop("_nth", "_length")

    light = heavy.others(rows, key) if heavy else rows
    order = Window.partitionBy(key).orderBy(by_length)
    best = light.withColumn("_nth", F.rank().over(order)).where(F.col("_nth") == 1)
    best = best.drop("_nth", "_length")
    if heavy:
        dense = heavy.of(rows, key)
        longest = small(dense.groupBy(key).agg(F.max("_length").alias("_length")), heavy.count, 100)
        best = best.unionByName(dense.join(longest, [key, "_length"]).drop("_length"))
    return best


def address_rows(
    address: DataFrame,
    country: DataFrame,
    ties: str = "all",
    overlong: str = "error",
    heavy: Keys | None = None,
) -> DataFrame:
    """Best addresses with country names, without birth places.

    An address without a type is no address. Text beyond the published width
    fails the job, or is cut with ``overlong="truncate"``. The lookup is
    broadcast by Spark as long as its size allows.
    """
    normal = address.where(F.col("AddressTypeDesc") != BIRTH_PLACE)
    best = best_by_length(
        normal.select(KEY, "Address1", "Address2", "City", "ISOStandard"),
        KEY, ["Address1", "Address2", "City", "ISOStandard"], ties, heavy,
    )
    names = country.select("tISO", F.col("tCountry").alias("Country"))
    return best.join(names, best["ISOStandard"] == names["tISO"], "left").select(
        KEY,
        fit(F.col("Address1"), 255, overlong, "AddressLine1").alias("AddressLine1"),
        fit(F.col("Address2"), 255, overlong, "AddressLine2").alias("AddressLine2"),
        fit(F.col("City"), 50, overlong, "City").alias("City"),
        fit(F.col("ISOStandard"), 50, overlong, "CountryCode").alias("CountryCode"),
        "Country",
        F.lit(True).alias("HasAddress"),
    )


def birth_places(address: DataFrame, overlong: str = "error") -> DataFrame:
    """Cities of the birth places, one row for each."""
    places = address.where(F.col(KEY).isNotNull() & (F.col("AddressTypeDesc") == BIRTH_PLACE))
    return places.select(KEY, fit(F.col("City"), 50, overlong, "POB").alias("POB"))


def format_address(
    address: DataFrame,
    country: DataFrame,
    ties: str = "all",
    overlong: str = "error",
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Best addresses with country name and birth place.

    Every birth place multiplies the addresses of its entity; an entity with a
    birth place only has no row.
    """
    places = birth_places(address, overlong)
    sources = {HUB: address.where(F.col("AddressTypeDesc") != BIRTH_PLACE), "birth_place": places}
    heavy = heavy_keys(sources, policy)
    best = address_rows(address, country, ties, overlong, heavy.keys(HUB))
    splits = split_counts({HUB: best, "birth_place": places}, policy, heavy=heavy)
    return star_join(best, [Satellite("birth_place", places)], splits).select(
        KEY, "AddressLine1", "AddressLine2", "City", "CountryCode", "POB", "Country"
    )
