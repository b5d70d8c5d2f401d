"""The full run: staging tables to the published list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.consolidate import (
    distinct_profiles, joined_attributes, many_inputs, nameless_profiles, with_list_type,
)
from ..operators.publish import ALIAS, alias_satellite, list_rows, publish, publish_base, stored_ids
from ..operators.views import run_summary
from ..schemas import KEY
from .pointer import current, point_to, pointers
from .shared import split_size
from .skew import DEFAULT_POLICY, SkewPolicy

SUMMARIES = "summaries"
#: Wide rows that a task sorts at once: about 0.4 GB of those of the stand-in feed.
SORTED_ROWS = 200_000
_LEAST_SPLIT = 1 << 16


def build_watchlist(
    tables: dict[str, DataFrame],
    version_id: str,
    run_ts: str | None = None,
    row_limit: int | None = None,
    dedup: bool = False,
    policy: SkewPolicy = DEFAULT_POLICY,
    **options,
) -> DataFrame:
    """The list without ids, as one plan from the staging tables.

    The aliases are one more satellite of the star join, so the wide profile
    rows are neither stored nor shuffled on the way to the list.
    """
    alias = tables["EntityAlias"]
    if dedup:
        profiles, anonymous = distinct_profiles(tables, row_limit, policy, **options)
        sources = many_inputs(tables, row_limit) | {ALIAS: alias}
        listed = publish(profiles, alias, version_id, run_ts, policy, sources)
        return listed.unionByName(publish_base(anonymous, version_id, run_ts))
    joined = joined_attributes(
        tables, row_limit, False, policy, last=alias_satellite(alias, policy), anonymous=False, **options
    )
    rows = with_list_type(joined)
    # United last: rows that cross a union are written out once more on the way.
    others = publish_base(nameless_profiles(tables, row_limit, rows), version_id, run_ts)
    return list_rows(rows, version_id, run_ts).unionByName(others)


def write_watchlist(watchlist: DataFrame, root: str, version_id: str, dense_ids: bool = False) -> str:
    """Store the rows of a version beside the older ones; ``run`` publishes it.

    Each file is sorted by entity and alias, so row groups can be skipped by them. The rows are stored
    unsorted first, so that their number and size are known and each task sorts only as many as
    it can hold. A published version is never overwritten; what an interrupted run of this version
    left is replaced.
    """
    if any(p["version"] == version_id for p in pointers(watchlist.sparkSession, root)):
        raise FileExistsError(f"version {version_id} exists under {root}")
    path = f"{root}/version={version_id}"
    rows, n, size = stored_ids(watchlist, dense_ids)
    ordered = rows.sortWithinPartitions(KEY, "EntityAliasGUID")
    with split_size(watchlist.sparkSession, max(_LEAST_SPLIT, size * SORTED_ROWS // max(n, 1))):
        ordered.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return path


def latest_version(spark: SparkSession, root: str) -> str:
    """The version that was published last."""
    found = current(spark, root)
    if found is None:
        raise ValueError(f"no complete version under {root}")
    return found["version"]


def read_watchlist(spark: SparkSession, root: str, version_id: str | None = None) -> DataFrame:
    """A stored version of the list, by default the one published last."""
    return spark.read.parquet(f"{root}/version={version_id or latest_version(spark, root)}")


def read_summary(spark: SparkSession, root: str, version_id: str | None = None) -> DataFrame:
    """The summary that belongs to a version, by default to the one published last."""
    return spark.read.parquet(f"{root}/{SUMMARIES}/version={version_id or latest_version(spark, root)}")


def run(
    tables: dict[str, DataFrame],
    root: str,
    version_id: str,
    run_ts: str | None = None,
    dense_ids: bool = False,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """Build and store one version and its summary; returns both as stored.

    Readers see the version when its pointer is written, after list and summary: a run that
    dies at any step leaves the version published before.
    """
    watchlist = build_watchlist(tables, version_id, run_ts, **options)
    write_watchlist(watchlist, root, version_id, dense_ids)
    spark = watchlist.sparkSession
    stored = read_watchlist(spark, root, version_id)
    summary = run_summary(stored, run_ts).coalesce(1)
    summary.write.mode("overwrite").parquet(f"{root}/{SUMMARIES}/version={version_id}")
    point_to(spark, root, lambda _: {"version": version_id})
    return stored, read_summary(spark, root, version_id)
