"""Compare every registered query with its DuckDB answer.

python -m checks.compare [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime
import decimal
import io
import math
import sys
import time
from collections import Counter
from contextlib import redirect_stdout

import duckdb
from pyspark.sql import SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def local_session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, (decimal.Decimal, float)):
        return round(float(value), 6)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def bag(columns, rows) -> Counter:
    """Rows as a multiset, columns in name order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def spark_bag(df) -> Counter:
    return bag(df.columns, [tuple(r) for r in df.collect()])


def duck_bag(con, sql):
    cursor = con.execute(sql)
    return bag([c[0] for c in cursor.description], cursor.fetchall())


def physical_plan(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


def main(argv: list[str]) -> int:
    from checks.queries import REGISTRY

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(REGISTRY)
    spark, con, wrong = local_session(), duck(sf_dir), 0
    for name in names:
        query, sql = REGISTRY[name]
        started = time.time()
        try:
            df = query(spark, sf_dir)
            ours = spark_bag(df)
            seconds = time.time() - started
            cursor = con.execute(sql)
            same_names = sorted(df.columns) == sorted(c[0] for c in cursor.description)
            theirs = bag([c[0] for c in cursor.description], cursor.fetchall())
            ok = same_names and ours == theirs
            print(f"{'ok ' if ok else 'BAD'} {name}: {ours.total()} / {theirs.total()} rows, {seconds:.2f} s")
            if not ok:
                wrong += 1
                print("   names", same_names, "ours only", list((ours - theirs).items())[:2],
                      "theirs only", list((theirs - ours).items())[:2])
        except Exception as failure:  # noqa: BLE001 - report and go on with the next query
            wrong += 1
            print(f"BAD {name}: {str(failure)[:600]}")
    print(f"{len(names) - wrong} of {len(names)} agree")
    return wrong


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
