"""The folder that the driver and all executors see, and tables stored there."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

BROADCAST_BYTES = 32 << 20


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, else the warehouse; an error if the session has neither."""
    for name in ("spark.checkpoint.dir", "spark.sql.warehouse.dir"):
        folder = spark.conf.get(name, None)
        if folder:
            return folder.rstrip("/")
    raise ValueError("set spark.checkpoint.dir to a folder that all executors see")


def stored(df: DataFrame, name: str, **facts: Column) -> tuple[DataFrame, dict[str, int]]:
    """``df`` written once to the shared folder and read back, and aggregates over it from that same write."""
    rows, _, seen = stored_at(df, name, **facts)
    return rows, seen


def stored_at(
    df: DataFrame, name: str, group_rows: int | None = None, **facts: Column
) -> tuple[DataFrame, str, dict[str, int]]:
    """``stored``, with the folder of the rows; ``group_rows``: most rows of a row group, which is read by one task."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    seen = Observation()
    found = df.observe(seen, *[value.alias(fact) for fact, value in facts.items()])
    options = {"parquet.block.row.count.limit": group_rows} if group_rows else {}
    found.write.option("compression", "zstd").options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path, {k: v or 0 for k, v in seen.get.items()}


def bytes_under(spark: SparkSession, path: str) -> int:
    """Bytes of all files under a folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()


@contextmanager
def split_size(spark: SparkSession, size: int) -> Iterator[None]:
    """What is run inside reads files in parts of at most ``size`` bytes, one part per task."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}
    try:
        for name in names:
            spark.conf.set(name, str(size))
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def small(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """``df`` marked for broadcast if ``rows`` of about ``row_bytes`` fit; else left to a shuffle join."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df
