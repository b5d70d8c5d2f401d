"""Staging tables in buckets: the same list, without an exchange."""

import pytest
from pyspark.sql import functions as F

from checks.compare import physical_plan, spark_bag
from checks.fixtures import feed
from screenroll.operators import consolidate
from screenroll.plans.build import build_watchlist
from screenroll.plans.pointer import current
from screenroll.plans.skew import SkewPolicy
from screenroll.sources.buckets import bucket_feed, bucketed_feed, over_buckets

SF = "/root/testdata/sf0.001"
TS = "2024-05-17 08:30:00"


@pytest.fixture(scope="module")
def tables(spark):
    """The feed, with an entity and an alias that have no id."""
    made = feed(spark, SF)
    for name in ("Entity", "EntityAlias"):
        nameless = made[name].limit(1).withColumn("EntityGUID", F.lit(None).cast("string"))
        made[name] = made[name].unionByName(nameless)
    return made


@pytest.fixture
def no_small_tables(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_the_star_join_reads_buckets_without_an_exchange(spark, tables, tmp_path, no_small_tables):
    light, apart = bucket_feed(tables, str(tmp_path / "by-entity"), 4)
    assert apart["Entity"].count() == 1 and apart["EntityDOB"].count() == 0
    light["Country"] = F.broadcast(light["Country"])
    for dedup in (False, True):
        listed = over_buckets(build_watchlist, (light, None), "7", TS, dedup=dedup)
        text = physical_plan(listed)
        assert "Exchange hashpartitioning" not in text and "Exchange rangepartitioning" not in text
        assert text.count("SortMergeJoin") >= 10


def test_both_halves_give_the_whole_list(spark, tables, tmp_path):
    root = str(tmp_path / "by-entity")
    policy = SkewPolicy(rows_per_task=30)
    halves = bucket_feed(tables, root, 4, policy)
    whole = spark_bag(build_watchlist(tables, "7", TS))
    assert spark_bag(over_buckets(build_watchlist, halves, "7", TS, policy=policy)) == whole
    light, apart = halves
    assert apart["EntityIdentification"].count() > 0 and light["EntityIdentification"].count() > 0
    for name in ("Entity", "EntityAlias", "EntityIdentification"):
        assert light[name].count() + apart[name].count() == tables[name].count()
    assert light["EntityAlias"].groupBy("EntityGUID").count().agg(F.max("count")).first()[0] <= 30
    profiles = over_buckets(consolidate, bucketed_feed(spark, root), policy=policy)
    assert spark_bag(profiles) == spark_bag(consolidate(tables))


def test_a_new_session_finds_the_buckets(spark, tables, tmp_path, no_small_tables):
    root = str(tmp_path / "by-entity")
    some = {name: tables[name] for name in ("EntityDOB", "EntityAlias", "Country")}
    light, _ = bucket_feed(some, root, 3)
    names = []
    for table in spark.catalog.listTables():
        if table.name.startswith("by_entity_"):
            names.append(table.name)
            spark.sql(f"drop table {table.name}")
    assert names
    again, _ = bucketed_feed(spark, root)
    assert {t: spark_bag(df) for t, df in again.items()} == {t: spark_bag(df) for t, df in light.items()}
    joined = again["EntityDOB"].join(again["EntityAlias"], "EntityGUID")
    assert "Exchange" not in physical_plan(joined)


def test_buckets_grow_with_the_rows(spark, small_feed, tmp_path):
    def buckets(entities, root):
        rows = [{"EntityGUID": f"E{i}", "EntityTypeDesc": "Individual"} for i in range(entities)]
        tables = small_feed(Entity=rows, EntityDOB=[{"EntityGUID": r["EntityGUID"], "BirthYear": "1970"} for r in rows])
        light, heavy = bucket_feed(tables, str(tmp_path / root), 2, SkewPolicy(rows_per_task=50))
        assert heavy is None and light["Entity"].count() == entities
        assert over_buckets(build_watchlist, (light, heavy), "1").count() == entities
        return current(spark, str(tmp_path / root))["buckets"]

    # Both tables have a row of each entity.
    assert (buckets(20, "a"), buckets(100, "b"), buckets(400, "c")) == (2, 4, 16)
