"""Profiles, list rows, views and stored versions."""

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.compare import physical_plan, spark_bag
from checks.fixtures import feed
from screenroll.operators import (
    assign_ids, consolidate, filter_view, master_view, publish, publish_alias, publish_base, run_summary,
)
from screenroll.plans.build import build_watchlist, latest_version, read_watchlist, run
from screenroll.plans.skew import SkewPolicy, Splits, heavy_keys, split_counts
from screenroll.plans.star import Satellite, star_join
from screenroll.schemas import PROFILE_COLUMNS, WATCHLIST_COLUMNS
from screenroll.sources import collate

KEY = "EntityGUID"
SF = "/root/testdata/sf0.001"
TS = "2024-05-17 08:30:00"


def link(kind, iso="FR", key="E1"):
    return {KEY: key, "AssociationTypeDesc": kind, "ISOStandard": iso, "AdministrativeUnitName": "u"}


def source(name, key="E1"):
    return {KEY: key, "SourceName": name}


def types(rows_of, tables, **options):
    return [r[0] for r in rows_of(consolidate(tables, **options), "WLType")]


def test_entity_without_anything_stays(small_feed):
    got = consolidate(small_feed()).collect()
    assert len(got) == 1 and got[0].asDict() == {
        **dict.fromkeys(PROFILE_COLUMNS), KEY: "E1", "ReferenceID": "1", "EntityType": "Individual",
        "FirstName": "Ann ", "LastName": "Cid", "SecondName": "Ann Bo Cid"}


def test_enforcement_comes_before_sanction(small_feed, rows_of):
    both = small_feed(EntityEnforcement=[source("F")], EntitySanction=[source("G"), source("H")])
    assert types(rows_of, both) == ["F", "F"]
    assert types(rows_of, both, dedup=True) == ["F"]
    gap = small_feed(EntityEnforcement=[source(None), source("x" * 60)], EntitySanction=[source("G")])
    assert types(rows_of, gap) == ["G", "x" * 50]


@pytest.mark.parametrize("sources, expected", [
    ([], ["PEP"]), (["PEP"], ["PEP"]), ([None], ["PEP"]), (["F"], ["F", "PEP"]),
    (["F", "PEP"], ["F", "PEP", "PEP"]),
])
def test_exposed_entity(small_feed, rows_of, sources, expected):
    tables = small_feed(EntityEnforcement=[source(s) for s in sources],
                        EntityCountryAssociation=[link("PEP"), link("PEP")])
    assert types(rows_of, tables) == expected
    assert types(rows_of, tables, dedup=True) == sorted(set(expected))


def test_attributes_multiply(small_feed, rows_of):
    tables = small_feed(
        EntityCountryAssociation=[link("Nationality"), link("Nationality"), link("Citizenship"),
                                  link("Citizenship", "DE")],
        EntitySanction=[source("A"), source("B"), source("B")],
        EntityAddress=[{KEY: "E1", "AddressTypeDesc": "Home", "Address1": a} for a in ("ab", "cd")])
    got = consolidate(tables)
    assert got.count() == 2 * 2 * 3 * 2
    assert consolidate(tables, dedup=True).count() == 1 * 2 * 2 * 2


def two_branches(tables):
    """The profiles the long way: one query per branch, each over joins of its own."""
    from screenroll.operators.consolidate import joined_attributes

    rows = joined_attributes(tables)
    exposed = F.col("_exposed").isNotNull()
    listed = rows.where(~exposed | (F.col("_source").isNotNull() & (F.col("_source") != "PEP")))
    listed = listed.withColumn("WLType", F.substring("_source", 1, 50))
    again = joined_attributes({name: df.select("*") for name, df in tables.items()})
    pep = again.where(exposed).withColumn("WLType", F.lit("PEP"))
    return listed.select(*PROFILE_COLUMNS).unionByName(pep.select(*PROFILE_COLUMNS))


def test_one_pass_equals_two_branches(spark):
    tables = feed(spark, SF)
    assert spark_bag(consolidate(tables)) == spark_bag(two_branches(tables))


def test_entities_without_id_bypass_the_joins(small_feed, rows_of):
    tables = small_feed(Entity=[{KEY: None, "EntityID": "7"}] * 2 + [{KEY: "E1", "EntityID": "1"}],
                        EntityAlias=[{KEY: None, "AliasTypeDesc": "AKA", "Name": "n"}],
                        EntitySanction=[source("G"), {KEY: None, "SourceName": "x"}])
    expected = [("1", "G"), ("7", None), ("7", None)]
    assert rows_of(consolidate(tables), "ReferenceID", "WLType") == expected
    assert rows_of(consolidate(tables, dedup=True), "ReferenceID", "WLType") == expected[:2]
    assert rows_of(build_watchlist(tables, "1", TS), "ReferenceID", "WLType") == expected


def test_row_limit(small_feed, rows_of):
    tables = small_feed(Entity=[{KEY: k} for k in ("E3", "E1", "E2", "E4")])
    assert rows_of(consolidate(tables, row_limit=2), KEY) == [("E1",), ("E2",)]


def test_collation_is_opt_in(small_feed, rows_of):
    tables = small_feed(
        Entity=[{KEY: "e1 ", "EntityID": "1"}],
        EntityCountryAssociation=[link("pep  "), link("NATIONALITY", "fr")],
        EntityAddress=[{KEY: "E1", "AddressTypeDesc": "place of birth", "City": "Rom"},
                       {KEY: "E1", "AddressTypeDesc": "Home", "Address1": "a"}],
        EntityIdentification=[{KEY: "E1", "IdentificationTypeDesc": "NATIONAL ID", "IdentificationNumber": "5"}])
    columns = ["WLType", "Nationality", "AddressLine1", "POB", "NationalIDNo"]
    assert rows_of(consolidate(tables), *columns) == [(None,) * 5]
    assert rows_of(consolidate(collate(tables)), *columns) == [("PEP", "France", "a", "Rom", "5")]


@pytest.fixture(autouse=True, scope="module")
def quick_small_plans(spark):
    """Rows are few and plans are large here, so compiling and re-planning would dominate."""
    settings = {"spark.sql.codegen.wholeStage": "false", "spark.sql.adaptive.enabled": "false"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name in settings:
        spark.conf.unset(name)


# --- heavy keys -----------------------------------------------------------------------


def test_spread_plan_gives_the_same_list(spark):
    tables = feed(spark, SF)
    policy = SkewPolicy(rows_per_task=3)
    plain = spark_bag(build_watchlist(tables, "7", TS))
    assert spark_bag(build_watchlist(tables, "7", TS, policy=policy)) == plain


def test_spread_dedup(spark):
    tables = feed(spark, SF)
    policy = SkewPolicy(rows_per_task=2)
    assert spark_bag(consolidate(tables, dedup=True, policy=policy)) == spark_bag(
        consolidate(tables, dedup=True))


def found(splits):
    """Splits as ``{frame: {key: parts}}``."""
    out = {}
    for r in splits.rows.collect() if splits else []:
        out.setdefault(r["_spread"], {})[r["_heavy"]] = r["_parts"]
    assert not splits or splits.counts == {name: len(keys) for name, keys in out.items()}
    return out


def splits_of(spark, spread):
    rows = [(k, name, n) for name, keys in spread.items() for k, n in keys.items()]
    return Splits(spark.createDataFrame(rows, "_heavy string, _spread string, _parts int"),
                  {name: len(keys) for name, keys in spread.items()})


def test_heavy_keys_are_counted_whatever_the_size(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias(KEY))
    policy = SkewPolicy(rows_per_task=100)
    assert heavy_keys({"t": df}).keys("t") is None and heavy_keys({"t": df}).products() is None
    heavy = heavy_keys({"t": df, "u": df.where("EntityGUID < '2'")}, policy, joined=["u"])
    assert [tuple(r) for r in heavy.keys("t").rows.collect()] == [("hot", 334)] and heavy.keys("t").most == 334
    assert heavy.keys("u") is None and heavy.products() is None
    assert heavy.keys("t").of(df, KEY).count() == 334 and heavy.keys("t").others(df, KEY).count() == 666
    assert found(split_counts({"t": df}, policy)) == {"t": {"hot": 4}}
    assert found(split_counts({"t": df.where("id < 100")}, policy, heavy=heavy_keys({"t": df}, policy))) == {}


def test_one_key_in_a_tiny_file_is_split(spark, tmp_path):
    path = str(tmp_path / "hot")
    spark.range(3_000_000).select(F.lit("hot").alias(KEY)).write.parquet(path)
    assert found(split_counts({"t": spark.read.parquet(path)})) == {"t": {"hot": 2}}


def test_products_of_a_key_are_split(spark):
    rows = spark.range(900).select(F.lit("hot").alias(KEY))
    assert found(split_counts({"a": rows, "b": rows}, SkewPolicy(rows_per_task=1000))) == {"b": {"hot": 810}}


def test_all_heavy_keys_are_split(spark):
    rows = spark.range(20_000).select((F.col("id") % 20).cast("string").alias(KEY))
    got = split_counts({"t": rows}, SkewPolicy(rows_per_task=500))
    assert found(got) == {"t": {str(k): 2 for k in range(20)}}


def test_a_million_heavy_keys_do_not_reach_the_driver(spark, monkeypatch):
    """They stay a table, beyond the size for broadcasts a shuffled one, and the join is the same."""
    keys = spark.range(1_000_000).select(F.col("id").cast("string").alias(KEY))
    many = keys.select(KEY, F.explode(F.array(F.lit(1), F.lit(2), F.lit(2))).alias("m"))
    for name in ("collect", "toArrow", "toPandas", "toLocalIterator"):
        monkeypatch.setattr(DataFrame, name, lambda self, *a, **b: pytest.fail("rows of a table reached the driver"))
    policy = SkewPolicy(rows_per_task=2)
    heavy = heavy_keys({"hub": keys, "many": many}, policy)
    assert heavy.facts["products"] == 1_000_000 and heavy.keys("many").count == 1_000_000
    splits = split_counts({"hub": keys, "many": many}, policy, heavy=heavy)
    assert splits.counts == {"many": 1_000_000}
    joined = star_join(keys, [Satellite("many", many)], splits)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in physical_plan(joined)
        monkeypatch.undo()
        assert joined.agg(F.count("*"), F.sum("m"), F.count_distinct(KEY)).first() == (3_000_000, 5_000_000, 1_000_000)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("spread", [
    {"many": {"a": 4}}, {"hub": {"a": 3}}, {"part": {"a": 5}}, {"many": {"a": 4}, "part": {"b": 2, "c": 3}},
])
def test_salted_star_equals_plain_star(spark, spread):
    hub = spark.createDataFrame(
        [("a", 1), ("a", 1), ("a", 2), ("b", 3), ("c", 4), ("d", 5), (None, 6)], "EntityGUID string, h int")
    many = spark.createDataFrame(
        [("a", i % 3) for i in range(50)] + [("b", 9), ("z", 9)], "EntityGUID string, m int"
    ).withColumn("HasMany", F.lit(True))
    part = spark.createDataFrame(
        [("a", 7)] * 11 + [("b", 1), ("b", 2), ("b", 2)] + [("c", i) for i in range(9)],
        "EntityGUID string, p int")
    satellites = [Satellite("many", many), Satellite("part", part, only_with="HasMany")]
    assert spark_bag(star_join(hub, satellites, splits_of(spark, spread))) == spark_bag(star_join(hub, satellites))


def test_copies_are_spread_evenly(spark):
    hub = spark.createDataFrame([("a",)], "EntityGUID string")
    many = spark.range(100_000).select(F.lit("a").alias(KEY), F.lit(1).alias("m"))
    from screenroll.plans.star import _salted

    splits = splits_of(spark, {"many": {"a": 8}})
    rows = _salted("many", many, splits, KEY)
    assert [r["_copies"] for r in rows.collect()] == [12_500] * 8
    assert star_join(hub, [Satellite("many", many)], splits).count() == 100_000


# --- publishing -----------------------------------------------------------------------


def alias(kind, name="Al", **more):
    return {KEY: "E1", "EntityAliasGUID": "A1", "AliasTypeDesc": kind, "Name": name, **more}


def test_alias_rows(small_feed, rows_of):
    tables = small_feed(EntityAlias=[
        alias("AKA", "N" * 600, FirstName="F", LastName="L" * 300), alias(None), alias("Acronym"),
        alias("Call Sign"), alias("Chinese Commercial Code (CCC)"), alias("Native Script For Alias"),
        alias("Native Script For Entity")])
    got = publish_alias(consolidate(tables), tables["EntityAlias"], "1", TS).collect()
    assert len(got) == 1
    row = got[0]
    assert (row["FirstName"], row["LastName"], row["SecondName"], row["Alias"], row["EntityAliasGUID"]) == (
        "F ", "L" * 255, "N" * 500, "N" * 500, "A1")
    assert (row["VersionID"], row["Action"], row["FileName"], row["EntityType"]) == ("1", "add", "2024-05-17", "3")


def test_base_rows(small_feed):
    tables = small_feed(Entity=[{KEY: "E1", "Gender": "Undefined", "LastName": "l" * 200,
                                 "Name": "n" * 400, "Title": "t" * 400, "FirstName": "f"}])
    row = publish_base(consolidate(tables), "1", TS).first()
    assert (row["Gender"], row["LastName"], row["SecondName"], row["Title"]) == (
        "Undefin", "l" * 150, "n" * 300, "t" * 250)
    assert row["Alias"] is None and row["LastUpdatedBy"] is None and row["EntityType"] == "6"
    long = small_feed(Entity=[{KEY: "E1", "FirstName": "f" * 200, "MiddleName": "m" * 200}])
    with pytest.raises(Exception, match="FirstName is longer than 300"):
        publish_base(consolidate(long), "1", TS).collect()


def test_one_pass_publish_equals_base_plus_alias(spark):
    tables = feed(spark, SF)
    profiles, names = consolidate(tables), tables["EntityAlias"]
    parts = publish_base(profiles, "7", TS).unionByName(publish_alias(profiles, names, "7", TS))
    expected = spark_bag(parts)
    assert spark_bag(publish(profiles, names, "7", TS)) == expected
    assert spark_bag(build_watchlist(tables, "7", TS)) == expected


def test_ids(spark):
    df = spark.range(1000, numPartitions=7).where("id % 3 = 0").select("id")
    sparse = [r["ID"] for r in assign_ids(df.withColumnRenamed("id", "v")).collect()]
    assert len(set(sparse)) == 334
    dense = assign_ids(df.withColumnRenamed("id", "v"), dense=True)
    assert sorted(r["ID"] for r in dense.collect()) == list(range(1, 335))
    assert dense.count() == 334 and dense.columns == ["ID", "v"]
    assert assign_ids(spark.range(0).withColumnRenamed("id", "v"), dense=True).count() == 0


def test_views(spark, small_feed, rows_of):
    tables = small_feed(EntityAlias=[alias("AKA")])
    listed = assign_ids(build_watchlist(tables, "1", TS))
    assert listed.columns == WATCHLIST_COLUMNS and len(WATCHLIST_COLUMNS) == 43
    assert len(master_view(listed).columns) == 43
    assert rows_of(master_view(listed), "EntityType", "Basis") == [(3, "E1"), (3, "E1")]
    assert dict(master_view(listed).dtypes)["EntityType"] == "decimal(2,0)"
    assert rows_of(filter_view(listed), "FirstName", "LastName") == [(" " + " ", " " + " "), ("ANN  CID", "CID ANN ")]
    summary = run_summary(listed, TS)
    assert rows_of(summary, "Type", "Count") == [
        ("New Negative List Records", 2), ("Total Negative List Records", 2),
        ("Updated Negative List Records", 0)]
    odd = listed.withColumn("EntityType", F.lit("Vessel"))
    assert {r[0] for r in rows_of(master_view(odd), "EntityType")} == {4}


def test_versions_are_kept_and_switched(spark, small_feed, tmp_path):
    root, tables = str(tmp_path / "list"), small_feed(EntityAlias=[alias("AKA")])
    stored, summary = run(tables, root, "9", TS, dense_ids=True)
    assert sorted(r["ID"] for r in stored.collect()) == [1, 2]
    assert {r["Count"] for r in summary.collect()} == {0, 2}
    run(small_feed(), root, "10", TS)
    assert latest_version(spark, root) == "10" and read_watchlist(spark, root).count() == 1
    assert read_watchlist(spark, root, "9").count() == 2
    with pytest.raises(Exception, match="(?i)exists"):
        run(tables, root, "9", TS)
    (tmp_path / "list" / "version=11").mkdir()
    assert latest_version(spark, root) == "10"


def test_files_are_sorted_and_the_summary_is_stored(spark, tmp_path):
    from pathlib import Path

    import pyarrow.parquet as pq

    root = str(tmp_path / "list")
    stored, summary = run(feed(spark, SF), root, "1", TS)
    files = list(Path(root, "version=1").glob("*.parquet"))
    assert files
    for file in files:
        rows = pq.read_table(file, columns=[KEY, "EntityAliasGUID"]).to_pylist()
        order = [(r[KEY] or "", r["EntityAliasGUID"] or "") for r in rows]
        assert order == sorted(order)
    assert spark_bag(summary) == spark_bag(run_summary(stored, TS))
    assert list(Path(root, "summaries", "version=1").glob("*.parquet"))
