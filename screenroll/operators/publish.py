"""The published list: base rows, alias rows, ids."""

from __future__ import annotations

from datetime import datetime, timezone
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import encode_entity_type, fit, full_name
from ..plans.shared import bytes_under, small, stored_at
from ..plans.skew import DEFAULT_POLICY, NO_SKEW, SkewPolicy, heavy_keys, split_counts
from ..plans.star import HUB, Satellite, star_join
from ..schemas import EXCLUDED_ALIAS_TYPES, ID_SLOTS, KEY, WATCHLIST_COLUMNS

ALIAS = "alias"
_GROUP_ROWS = 50_000


def listed_aliases(alias: DataFrame) -> DataFrame:
    """Aliases that become list rows, under names of their own.

    Aliases without a type or of an excluded type are left out.
    """
    kept = alias.where(
        F.col(KEY).isNotNull() & ~F.col("AliasTypeDesc").isin(EXCLUDED_ALIAS_TYPES)
    )
    return kept.select(
        KEY,
        F.lit(True).alias("_alias"),
        F.col("EntityAliasGUID").alias("_alias_id"),
        F.col("Name").alias("_alias_name"),
        full_name(F.col("FirstName"), F.col("MiddleName")).alias("_alias_first"),
        F.col("LastName").alias("_alias_last"),
    )


def alias_satellite(alias: DataFrame, policy: SkewPolicy = DEFAULT_POLICY) -> Satellite:
    """Aliases plus one mark per entity that has any.

    A left join with it gives a row for each alias and one for the entity
    itself, so base and alias rows come from a single pass over the profiles.
    Without heavy entities the first alias of each makes the mark, which keeps
    the rows where they are.
    """
    rows = listed_aliases(alias)
    if policy == NO_SKEW:
        nth = F.row_number().over(Window.partitionBy(KEY).orderBy(KEY))
        kinds = F.when(nth == 1, F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(True)))
        both = rows.withColumn("_kinds", kinds).withColumn("_alias", F.explode("_kinds"))
        names = [F.when(F.col("_alias"), F.col(c)).alias(c) for c in rows.columns if c not in (KEY, "_alias")]
        return Satellite(ALIAS, both.select(KEY, "_alias", *names), source=rows)
    marks = rows.select(KEY).distinct().withColumn("_alias", F.lit(False))
    return Satellite(ALIAS, rows.unionByName(marks, allowMissingColumns=True), source=rows)


def _list_columns(version_id: str, run_ts: str | None, alias_row: Column | None) -> list[Column]:
    """Projection of profile rows to the list, without the id.

    ``alias_row`` tells alias rows from base rows; None if there are only base
    rows, and then no alias columns are read.
    """
    run_ts = run_ts or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    created = F.lit(run_ts).cast("timestamp_ntz")
    same = ["ReferenceID", "DOB", "ALTDOB1", "ALTDOB2", "ALTDOB3", "City", "Country", "WLType",
            "OriginalSource", "Remark", "NationalIDInfo", "NationalIDNo", *ID_SLOTS, KEY,
            "Nationality", "POB"]
    columns = {c: F.col(c) for c in same}
    columns |= {
        "EntityType": encode_entity_type(F.col("EntityType")),
        "Gender": fit(F.col("Gender"), 7),
        "FirstName": fit(F.col("FirstName"), 300, "error", "FirstName"),
        "LastName": fit(F.col("LastName"), 150),
        "SecondName": fit(F.col("SecondName"), 300),
        "Title": fit(F.col("Title"), 255),
        "AddressLine1": fit(F.col("AddressLine1"), 200),
        "AddressLine2": fit(F.col("AddressLine2"), 200),
        "Citizenship": fit(F.col("Citizenship"), 70),
        "EntityAliasGUID": F.lit(None).cast("string"),
        "Alias": F.lit(None).cast("string"),
        "VersionID": F.lit(str(version_id)),
        "Action": F.lit("add"),
        "FileName": F.date_format(created, "yyyy-MM-dd"),
        "CreationDate": created,
        "LastUpdatedBy": F.lit(None).cast("int"),
        "LastUpdatedDate": F.lit(None).cast("timestamp_ntz"),
    }
    if alias_row is not None:
        of_alias = {
            "FirstName": fit(F.col("_alias_first"), 300),
            "LastName": fit(F.col("_alias_last"), 255),
            "SecondName": fit(F.col("_alias_name"), 500),
            "EntityAliasGUID": F.col("_alias_id"),
            "Alias": fit(F.col("_alias_name"), 500),
        }
        for name, value in of_alias.items():
            columns[name] = F.when(alias_row, value).otherwise(columns[name])
    return [columns[c].alias(c) for c in WATCHLIST_COLUMNS if c != "ID"]


def publish_base(profiles: DataFrame, version_id: str, run_ts: str | None = None) -> DataFrame:
    """List rows of the profiles themselves, without ids."""
    return profiles.select(*_list_columns(version_id, run_ts, None))


def publish_alias(
    profiles: DataFrame,
    alias: DataFrame,
    version_id: str,
    run_ts: str | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """List rows of the aliases: the profile with the alias's names, without ids."""
    aliases = listed_aliases(alias)
    splits = split_counts({HUB: profiles.select(KEY), ALIAS: aliases}, policy)
    rows = star_join(profiles, [Satellite(ALIAS, aliases)], splits).where("_alias")
    return rows.select(*_list_columns(version_id, run_ts, F.col("_alias")))


def publish(
    profiles: DataFrame,
    alias: DataFrame,
    version_id: str,
    run_ts: str | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
    sources: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Base and alias rows in one pass over the profiles, without ids.

    Heavy keys are picked by the rows of ``sources``, else of stored profiles and aliases.
    """
    satellite = alias_satellite(alias, policy)
    heavy = heavy_keys(sources, policy) if sources else None
    splits = split_counts({HUB: profiles.select(KEY), ALIAS: satellite.rows}, policy, heavy=heavy)
    return list_rows(star_join(profiles, [satellite], splits), version_id, run_ts)


def list_rows(rows: DataFrame, version_id: str, run_ts: str | None = None) -> DataFrame:
    """List rows of profiles joined with the alias satellite."""
    alias_row = F.coalesce(F.col("_alias"), F.lit(False))
    return rows.select(*_list_columns(version_id, run_ts, alias_row))


def assign_ids(df: DataFrame, dense: bool = False) -> DataFrame:
    """Add a unique long ``ID`` as first column.

    By default ids are unique but not consecutive and cost nothing. ``dense``
    gives exactly 1..n: every row is stored together with its place (task and
    position) in the shared folder, the rows of each task are counted, and an
    id is the place behind the rows of all earlier tasks. Places are read, not
    worked out again, so they do not depend on how the files are split when
    they are counted and numbered.
    """
    if not dense:
        return df.select(F.monotonically_increasing_id().alias("ID"), "*")
    return stored_ids(df, True)[0]


def stored_ids(df: DataFrame, dense: bool) -> tuple[DataFrame, int, int]:
    """``assign_ids`` over rows that are stored first; also how many they are, and the bytes stored."""
    spark = df.sparkSession
    placed = df.withColumn("_place", F.monotonically_increasing_id())
    rows, path, facts = stored_at(placed, "rows", _GROUP_ROWS, n=F.count("*"))
    size = bytes_under(spark, path)
    if not dense:
        return rows.select(F.col("_place").alias("ID"), *df.columns), facts["n"], size
    part = F.shiftright("_place", 33).cast("int")
    position = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = rows.groupBy(part.alias("_part")).agg((F.max(position) + 1).alias("n")).orderBy("_part").toArrow()
    # One row per task that wrote rows, whatever the number of rows.
    before = [0, *accumulate(sizes.column("n").to_pylist())][: sizes.num_rows]
    first = spark.createDataFrame(
        pa.table({"_part": sizes.column("_part"), "_first": pa.array(before, pa.int64())})
    )
    numbered = (
        rows.withColumn("_part", part)
        .join(small(first, sizes.num_rows, 16), "_part")
        .select((F.col("_first") + position + 1).alias("ID"), *df.columns)
    )
    return numbered, facts["n"], size
