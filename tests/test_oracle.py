"""Every registered query against DuckDB on the smallest scale factor."""

import pytest

import __spark_entry__ as contract
from checks.compare import duck, duck_bag, physical_plan, spark_bag
from checks.oracle import STEPS, answer
from checks.fixtures import BASE, VIEWS

SF = "/root/testdata/sf0.001"

# Rows of each step at this scale, worked out beforehand (FIXTURES.md).
EXPECTED = {
    "src_new": 17, "address_best": 219, "address_new": 247, "citizenship_new": 171,
    "dob_new": 150, "national_new": 100, "ident_new": 50, "remark_new": 50,
    "nat": 111, "pep": 33, "nonpep_rows": 489, "pep_rows": 175,
    "consolidated": 664, "base_rows": 664, "alias_rows": 3713, "published": 4377,
    "summary_rows": 3,
}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(contract.FEED_QUERIES))
def test_query_equals_duckdb(spark, con, name):
    df = contract.queries()[name](spark, SF)
    sql = contract.oracle_sql()[name]
    assert sorted(df.columns) == sorted(c[0] for c in con.execute(sql).description)
    assert spark_bag(df) == duck_bag(con, sql)
    plan = physical_plan(df)
    assert "Python" not in plan and "ArrowEval" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


@pytest.mark.parametrize("step", sorted(EXPECTED))
def test_expected_row_counts(con, step):
    assert duck_bag(con, answer(step)).total() == EXPECTED[step]


def test_entry(spark):
    assert contract.entry(spark).count() == 4377


def test_step_names_do_not_hide_tables():
    assert not (set(VIEWS) | set(STEPS)) & set(BASE)
