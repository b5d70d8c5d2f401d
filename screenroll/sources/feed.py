"""Feed files: ``<folder>/<Table>.txt``, UTF-8, ``|`` between fields, LF rows, one header row.

Fields are never quoted and an empty field is NULL. A path may be one file or a
folder of part files; plain text files are split among tasks.
"""

from __future__ import annotations

import logging
import uuid
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import FIRST_YEAR
from ..plans.pointer import current, point_to
from ..schemas import FEED, feed_schema

log = logging.getLogger(__name__)

BAD_LINE = "_bad"
MAX_ERRORS = 10


def read_feed(
    spark: SparkSession, folder: str, table: str, max_errors: int | None = MAX_ERRORS
) -> tuple[DataFrame, DataFrame]:
    """Good rows of a feed table, and its bad rows as (``Table``, ``Reason``, ``Line``).

    A row is bad if it cannot be parsed, or if a field is wider than its
    column. More than ``max_errors`` bad rows fail the load; None skips this
    check, which reads the file once. A missing file gives no rows.
    """
    parsed = _parse(spark, folder, table)
    good, bad = _good(parsed, table), _bad(parsed, table)
    if max_errors is not None:
        _check_budget(bad.limit(max_errors + 1).count(), table, max_errors)
    return good, bad


def read_tables(
    spark: SparkSession,
    folder: str,
    tables: list[str] | None = None,
    max_errors: int | None = MAX_ERRORS,
) -> dict[str, DataFrame]:
    """Good rows of all feed tables by name."""
    return {t: read_feed(spark, folder, t, max_errors)[0] for t in tables or list(FEED)}


def stage_feed(
    spark: SparkSession,
    folder: str,
    target: str,
    tables: list[str] | None = None,
    max_errors: int = MAX_ERRORS,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Load the feed into Parquet under ``target``, replacing what is there.

    Each file is parsed once: one write stores good rows and quarantined rows
    side by side and counts both. The tables go to a folder of this load;
    when all keep their budget of bad rows, one pointer file makes them the
    current ones. A load that fails or dies at any step leaves the old tables
    current, and running readers keep the files that they have resolved.
    Tables that are not loaded stay as they are. Returns the good rows of the
    loaded tables, and the audit.
    """
    names = tables or list(FEED)
    loading = f"load={uuid.uuid4().hex}"
    loaded = {table: _load(spark, folder, target, f"{loading}/{table}", table, max_errors) for table in names}
    point_to(spark, target, lambda old: {"tables": (old or {}).get("tables", {}) | loaded})
    staged = {table: _staged(spark, table, f"{target}/{entry['path']}") for table, entry in loaded.items()}
    return staged, _audit(spark, loaded)


def staged_tables(spark: SparkSession, target: str) -> dict[str, DataFrame]:
    """Good rows of the current tables under ``target``, all of one state: the pointer is read once."""
    entries = _current_entries(spark, target)
    return {table: _staged(spark, table, f"{target}/{entry['path']}") for table, entry in entries.items()}


def staged_audit(spark: SparkSession, target: str) -> DataFrame:
    """Good and bad rows of the current tables, as counted by the loads that wrote them."""
    return _audit(spark, _current_entries(spark, target))


def quarantined(spark: SparkSession, target: str, table: str) -> DataFrame:
    """Bad rows of a current table as (``Table``, ``Reason``, ``Line``)."""
    path = _current_entries(spark, target)[table]["path"]
    rows = spark.read.schema(_stored_schema(table)).parquet(f"{target}/{path}").where(F.col("LoadState") == "bad")
    return rows.select(F.lit(table).alias("Table"), F.col("LoadReason").alias("Reason"), _line(table).alias("Line"))


def _current_entries(spark: SparkSession, target: str) -> dict[str, dict]:
    found = current(spark, target)
    if found is None:
        raise ValueError(f"no complete load under {target}")
    return found["tables"]


def _load(spark: SparkSession, folder: str, target: str, path: str, table: str, max_errors: int) -> dict:
    """Store the rows of one file, good and bad, under ``target``; counts come from the same pass."""
    reason = F.col("LoadReason")
    seen = Observation(f"load of {table}")
    (
        _parse(spark, folder, table)
        .withColumn("LoadReason", _reason(table))
        .withColumn("LoadState", F.when(reason.isNull(), "good").otherwise("bad"))
        .observe(seen, F.count_if(reason.isNull()).alias("good"), F.count_if(reason.isNotNull()).alias("bad"))
        .write.option("compression", "zstd").partitionBy("LoadState").parquet(f"{target}/{path}")
    )
    good, bad = seen.get["good"] or 0, seen.get["bad"] or 0
    log.info("%s: %d rows, %d bad", table, good, bad)
    _check_budget(bad, table, max_errors)
    return {"path": path, "good": good, "bad": bad}


def _stored_schema(table: str) -> T.StructType:
    schema = feed_schema(table)
    for name in (BAD_LINE, "LoadReason", "LoadState"):
        schema = schema.add(name, T.StringType())
    return schema


def _staged(spark: SparkSession, table: str, path: str) -> DataFrame:
    stored = spark.read.schema(_stored_schema(table)).parquet(path)
    return stored.where(F.col("LoadState") == "good").select(*FEED[table])


def _audit(spark: SparkSession, loaded: dict[str, dict]) -> DataFrame:
    return spark.createDataFrame(pa.table({
        "TableName": pa.array(loaded, pa.string()),
        "Rows": pa.array([e["good"] for e in loaded.values()], pa.int64()),
        "BadRows": pa.array([e["bad"] for e in loaded.values()], pa.int64()),
    }))


def load_audit(tables: dict[str, DataFrame], bad: dict[str, DataFrame] | None = None) -> DataFrame:
    """Number of good and bad rows of each table, one line for each."""
    bad = bad or {}
    lines = []
    for name, df in tables.items():
        counted = df.select(F.lit(name).alias("TableName"), F.lit(1).alias("g"), F.lit(0).alias("b"))
        if name in bad:
            counted = counted.unionByName(
                bad[name].select(
                    F.lit(name).alias("TableName"), F.lit(0).alias("g"),
                    F.when(F.col("Reason").isNotNull(), 1).otherwise(0).alias("b"),
                )
            )
        lines.append(
            counted.agg(
                F.lit(name).alias("TableName"),
                F.coalesce(F.sum("g"), F.lit(0)).alias("Rows"),
                F.coalesce(F.sum("b"), F.lit(0)).alias("BadRows"),
            )
        )
    return reduce(DataFrame.unionByName, lines)


def collate(tables: dict[str, DataFrame], collation: str = "UTF8_LCASE_RTRIM") -> dict[str, DataFrame]:
    """Tables that compare without regard to case and trailing blanks.

    Opt-in: without it all comparisons are binary. Labels and source names get
    the collation; ids and country codes, which are joined on, get one upper
    case spelling. Merged texts stay binary.
    """
    def compared(name: str) -> Column:
        if name in ("EntityGUID", "ISOStandard", "tISO"):
            return F.upper(F.rtrim(name)).alias(name)
        if name == "SourceName" or name.endswith("TypeDesc"):
            return F.collate(name, collation).alias(name)
        return F.col(name)

    return {table: df.select(*[compared(c) for c in df.columns]) for table, df in tables.items()}


def _parse(spark: SparkSession, folder: str, table: str) -> DataFrame:
    schema = feed_schema(table).add(BAD_LINE, T.StringType())
    path = f"{folder}/{table}.txt"
    if not _exists(spark, path):
        log.warning("no file for %s, skipping", table)
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
    return (
        spark.read.schema(schema)
        .option("sep", "|").option("header", True).option("quote", "").option("escape", "")
        .option("lineSep", "\n").option("encoding", "UTF-8")
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_LINE)
        .csv(path)
    )


def _reason(table: str) -> Column:
    """Why a parsed row is bad; NULL for a good one."""
    reason = F.when(F.col(BAD_LINE).isNotNull(), F.lit("unreadable"))
    for name, width in FEED[table].items():
        if width == "ts":
            reason = reason.when(F.year(name) < FIRST_YEAR, F.lit(f"{name} out of range"))
        elif width:
            reason = reason.when(F.length(F.rtrim(name)) > width, F.lit(f"{name} too long"))
    return reason


def _good(parsed: DataFrame, table: str) -> DataFrame:
    return parsed.where(_reason(table).isNull()).drop(BAD_LINE)


def _line(table: str) -> Column:
    """The text of a bad row; of a readable one, its fields joined again."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in FEED[table]]
    return F.coalesce(F.col(BAD_LINE), F.concat_ws("|", *fields))


def _bad(parsed: DataFrame, table: str) -> DataFrame:
    return (
        parsed.withColumn("Reason", _reason(table))
        .where(F.col("Reason").isNotNull())
        .select(F.lit(table).alias("Table"), "Reason", _line(table).alias("Line"))
    )


def _check_budget(bad: int, table: str, max_errors: int) -> None:
    if bad > max_errors:
        raise ValueError(f"{table}: more than {max_errors} bad rows")


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)
