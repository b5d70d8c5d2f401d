"""Shapes of physical plans that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

from checks.compare import physical_plan as plan
from checks.fixtures import feed, view
from screenroll.operators import (
    best_by_length, consolidate, format_address, format_birth_dates, map_nationality,
    merge_national_ids, merge_remarks, pivot_other_ids,
)
from screenroll.plans.build import build_watchlist

SF = "/root/testdata/sf0.001"


@pytest.fixture
def no_small_tables(spark):
    """Plan as for tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_groups_are_limited_before_the_shuffle(spark):
    address, dob, ident = (view(spark, SF, n) for n in ("address", "dob", "ident"))
    for df in (best_by_length(address, "EntityGUID", ["Address1"]), format_birth_dates(dob),
               pivot_other_ids(ident), merge_national_ids(ident)):
        assert re.search(r"WindowGroupLimit .* Partial", plan(df))


def test_remarks_are_limited_before_the_shuffle_at_the_suggested_setting(spark):
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "2000")
    try:
        assert re.search(r"WindowGroupLimit .* Partial", plan(merge_remarks(view(spark, SF, "remark"))))
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")


def test_lookup_is_broadcast_while_small(spark):
    assoc, country = view(spark, SF, "assoc"), view(spark, SF, "country")
    text = plan(map_nationality(assoc, country))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_filter_and_columns_reach_the_scan(spark):
    text = plan(map_nationality(view(spark, SF, "assoc"), view(spark, SF, "country")))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in text


def test_wide_rows_are_not_shuffled(spark, no_small_tables):
    """Above the first join there is no shuffle on the hub side, up to the list."""
    tables = feed(spark, SF)
    tables["Country"] = F.broadcast(tables["Country"])
    for df in (consolidate(tables), build_watchlist(tables, "1", "2024-01-01 00:00:00")):
        hub_side = [line for line in plan(df).splitlines() if re.match(r"^[ :]*:- ", line)]
        top = plan(df).split("SortMergeJoin", 1)[0]
        assert "Exchange" not in top and "Sort [" not in top
        # The only sort on a left side is that of the narrow hub (and of the stand-in tables).
        left_sorts = [x for x in hub_side if "Sort [EntityGUID" in x]
        assert len(left_sorts) == 1


def test_dedup_needs_no_shuffle_of_its_own(spark, no_small_tables):
    tables = feed(spark, SF)
    tables["Country"] = F.broadcast(tables["Country"])
    assert "Exchange" not in plan(consolidate(tables, dedup=True)).split("SortMergeJoin", 1)[0]


def test_dedup_list_joins_aliases_without_a_shuffle_of_the_profiles(spark, no_small_tables):
    tables = feed(spark, SF)
    tables["Country"] = F.broadcast(tables["Country"])
    text = plan(build_watchlist(tables, "1", "2024-01-01 00:00:00", dedup=True))
    above, alias_join, rest = text.partition("SortMergeJoin")
    profiles = rest.split("SortMergeJoin", 1)[0]
    assert alias_join and "Exchange" not in above and "Exchange" not in profiles


def test_address_join_shares_the_partitioning(spark, no_small_tables):
    text = plan(format_address(view(spark, SF, "address"), F.broadcast(view(spark, SF, "country"))))
    assert text.count("Exchange hashpartitioning") == 2
