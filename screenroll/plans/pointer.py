"""Which stored set of tables is current: numbered pointer files, the greatest complete one counts.

A set is written to folders of its own first; then one small file ``<root>/_pointers/<number>`` names
them all. Nothing is renamed, replaced or deleted, so a writer that dies after any step leaves the old
set or the new one. A file is created only if its number is free: of two writers at once, one takes
the next number and is newer. A pointer ends with the length of its text; one that was cut off
while it was written is passed over.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import SparkSession

_FOLDER = "_pointers"


def _folder(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{_FOLDER}")
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, root: str) -> list[int]:
    """Numbers of all pointer files, newest first."""
    folder, files = _folder(spark, root)
    if not files.exists(folder):
        return []
    names = [s.getPath().getName() for s in files.listStatus(folder)]
    return sorted((int(n) for n in names if n.isdigit()), reverse=True)


def _read(spark: SparkSession, root: str, number: int) -> dict | None:
    folder, files = _folder(spark, root)
    stream = files.open(spark._jvm.org.apache.hadoop.fs.Path(folder, f"{number:012d}"))
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    body, mark, size = text.rpartition("\n")
    return json.loads(body) if mark and size == f"{len(body)}." else None


def pointers(spark: SparkSession, root: str):
    """Complete pointers, newest first; read as they are asked for."""
    for number in _numbers(spark, root):
        found = _read(spark, root, number)
        if found is not None:
            yield found


def current(spark: SparkSession, root: str) -> dict | None:
    """What the newest complete pointer says; None if there is none."""
    return next(pointers(spark, root), None)


def point_to(spark: SparkSession, root: str, change: Callable[[dict | None], dict]) -> None:
    """Make ``change`` of the current content the new one; the last step of a writer.

    If another writer takes the number first, the change is made to its content.
    """
    folder, files = _folder(spark, root)
    files.mkdirs(folder)
    while True:
        number = max(_numbers(spark, root), default=0) + 1
        body = json.dumps(change(current(spark, root)), sort_keys=True)
        data = bytearray(f"{body}\n{len(body)}.".encode())
        path = spark._jvm.org.apache.hadoop.fs.Path(folder, f"{number:012d}")
        try:
            stream = files.create(path, False)
        except Exception:
            if number in _numbers(spark, root):
                continue
            raise
        try:
            stream.write(data)
        finally:
            stream.close()
        return
