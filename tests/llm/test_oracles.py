"""Queries against DuckDB, and the list of registered ones."""

import pytest

import corpus_pipeline
from checks.compare import duck, duck_bag, spark_bag

SF = "/root/testdata/sf0.001"
WITH_SQL = sorted(n for n, (_, sql) in corpus_pipeline.REGISTRY.items() if sql)


@pytest.mark.parametrize("name", WITH_SQL)
def test_query_equals_duckdb(spark, name):
    query, sql = corpus_pipeline.REGISTRY[name]
    con, df = duck(SF), query(spark, SF)
    assert sorted(df.columns) == sorted(c[0] for c in con.execute(sql).description)
    assert spark_bag(df) == duck_bag(con, sql)


def test_every_operator_is_registered():
    import __spark_entry__

    numbers = sorted(int(n[2:].split("_")[0]) for n in __spark_entry__.queries() if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in __spark_entry__.queries()


def test_native_operators_run_no_python(spark):
    from checks.compare import physical_plan

    for name in ("op1_pii", "op3_licenses"):
        plan = physical_plan(corpus_pipeline.REGISTRY[name][0](spark, SF))
        assert "Python" not in plan and "Arrow" not in plan
