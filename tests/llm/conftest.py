import os
from pathlib import Path

import pyarrow as pa
import pytest

# Workers of the local session import the package by path.
os.environ["PYTHONPATH"] = f"{Path(__file__).resolve().parents[2]}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (doc_id, text) pairs, with the other columns and a clashing one."""
    from screenroll.llm.common import ship

    ship(spark)

    def build(rows, **extra):
        ids, texts = [r[0] for r in rows], [r[1] for r in rows]
        columns = {"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string())}
        columns |= {c: pa.array([v] * len(rows), pa.string()) for c, v in extra.items()}
        return spark.createDataFrame(pa.table(columns))

    return build
