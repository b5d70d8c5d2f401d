"""Helpers of the corpus operators: staged tables, splits, Arrow texts."""

from __future__ import annotations

import ctypes
import shutil
import tempfile
import uuid
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.shared import shared_folder

BROADCAST_BYTES = 32 << 20
#: Bytes of rows that Spark sends to a Python worker at a time, and of texts that a worker takes on at once.
BATCH_BYTES, SLICE_BYTES = 4 << 20, 2 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
_SHIPPED: set[str] = set()
_HELD: dict = {}


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application; they need not have it installed.

    Bounds the batches that go to Python workers by bytes, unless the session has a smaller bound.
    """
    held = spark.conf.get(_BATCH_SETTING).rstrip("bB")
    if not held.isdigit() or int(held) > BATCH_BYTES:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        package = Path(__file__).resolve().parent.parent
        archive = shutil.make_archive(
            f"{tempfile.mkdtemp()}/{package.name}", "zip", package.parent, package.name)
        spark.sparkContext.addPyFile(archive)
        _SHIPPED.add(app)


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage, survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_or_plain(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """``df`` marked for broadcast if ``rows`` of about ``row_bytes`` fit; else left to a shuffle join."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def remainder(doc_id: Column | str, n: int) -> Column:
    """crc32 of the id as text, modulo n; NULL ids give NULL."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string").cast("binary")) % n


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def byte_texts(column: pa.Array) -> list[bytes]:
    """Texts of an Arrow string column as UTF-8 bytes, NULL as empty."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def held(key, make):
    """``make()``, kept by the worker for the tasks that follow until another operator's task runs in it."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


def give_back() -> None:
    """Return what Python has freed to the system: Spark keeps workers, and gives them tasks of other operators."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def slices(batches, rows: int = 512, most: int = SLICE_BYTES, holds: bool = False):
    """Arrow batches cut small by rows and bytes of text, so that Python objects of few texts exist at a time.

    What other operators hold in this worker goes, unless the caller ``holds`` something itself.
    """
    if not holds:
        _HELD.clear()
    try:
        yield from _cut(batches, rows, most)
    finally:
        give_back()


def _cut(batches, rows: int, most: int):
    for batch in batches:
        size = np.zeros(batch.num_rows, np.int64)
        for column in batch.columns:
            if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
                size += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(size), 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = min(max(int(np.searchsorted(ends, before + most, "right")), start + 1), start + rows, batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)
