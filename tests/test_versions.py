"""Stored sets of tables: a writer that dies after any step leaves the old set or the new one."""

import sys

import pytest
from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from screenroll.operators import assign_ids
from screenroll.plans import build, pointer
from screenroll.plans.build import latest_version, read_summary, read_watchlist, run
from screenroll.sources import feed, quarantined, stage_feed, staged_audit, staged_tables

TABLES = ["EntityDeletes", "Country", "EntityRemark"]
TS = "2024-05-17 08:30:00"


@pytest.fixture
def load(spark, tmp_path):
    """Load three tables whose rows name the load; returns what readers see."""
    target = str(tmp_path / "stage")

    def write(mark):
        folder = tmp_path / f"feed-{mark}"
        folder.mkdir(exist_ok=True)
        (folder / "EntityDeletes.txt").write_text(f"EntityGUID|DateDeleted\n{mark}|2024-01-01\nbad|never\n")
        (folder / "Country.txt").write_text(f"tISO|tCountry\n{mark}|land\n")
        (folder / "EntityRemark.txt").write_text(f"EntityGUID|EntityRemarkGUID|Remark|LastUpdated\n{mark}|r|t|2024-01-01\n")
        return stage_feed(spark, str(folder), target, TABLES)

    def seen():
        return {t: [r[0] for r in df.collect()] for t, df in staged_tables(spark, target).items()}

    return write, seen, target


class Killed(Exception):
    pass


def after(n, function):
    """``function``, which dies instead of its n-th call (from 0)."""
    calls = iter(range(n))

    def call(*args, **options):
        if next(calls, None) is None:
            raise Killed
        return function(*args, **options)

    return call


def test_a_killed_load_leaves_the_old_tables(spark, load, monkeypatch):
    write, seen, target = load
    with pytest.raises(ValueError, match="no complete load"):
        staged_tables(spark, target)
    write("old")
    old = {t: ["old"] for t in TABLES}
    assert seen() == old
    for n in range(3):
        with monkeypatch.context() as patch, pytest.raises(Killed):
            patch.setattr(DataFrameWriter, "parquet", after(n, DataFrameWriter.parquet))
            write(f"new{n}")
        assert seen() == old
    for step in ("_check_budget", "point_to"):
        with monkeypatch.context() as patch, pytest.raises(Killed):
            patch.setattr(feed, step, after(0, getattr(feed, step)))
            write(step)
        assert seen() == old
    write("new")
    assert seen() == {t: ["new"] for t in TABLES}


def test_a_pointer_cut_off_anywhere_is_passed_over(spark, load, tmp_path):
    write, seen, target = load
    write("old")
    write("new")
    last = max((tmp_path / "stage" / "_pointers").glob("0*"))
    whole = last.read_bytes()
    for checksum in last.parent.glob(".*.crc"):
        checksum.unlink()
    for size in range(0, len(whole), 37):
        last.write_bytes(whole[:size])
        assert seen()["Country"] == ["old"]
    last.write_bytes(whole[:-1])
    assert seen()["Country"] == ["old"]
    write("next")
    assert seen() == {t: ["next"] for t in TABLES}


def test_readers_keep_the_files_they_resolved(spark, load):
    write, seen, target = load
    write("old")
    before = staged_tables(spark, target)
    write("new")
    assert [r[0] for r in before["Country"].collect()] == ["old"]


def test_tables_that_are_not_loaded_stay(spark, load, tmp_path):
    write, seen, target = load
    write("old")
    (tmp_path / "one").mkdir()
    (tmp_path / "one" / "Country.txt").write_text("tISO|tCountry\nnew|land\n")
    staged, _ = stage_feed(spark, str(tmp_path / "one"), target, ["Country"])
    assert list(staged) == ["Country"]
    assert seen() == {"EntityDeletes": ["old"], "Country": ["new"], "EntityRemark": ["old"]}


def test_counts_and_bad_rows_of_the_current_load(spark, load):
    write, _, target = load
    _, audit = write("x")
    want = [("Country", 1, 0), ("EntityDeletes", 1, 1), ("EntityRemark", 1, 0)]
    assert sorted(map(tuple, audit.collect())) == sorted(map(tuple, staged_audit(spark, target).collect())) == want
    assert [tuple(r) for r in quarantined(spark, target, "EntityDeletes").collect()] == [
        ("EntityDeletes", "unreadable", "bad|never")]


def test_a_load_reads_each_file_once(spark, load, monkeypatch):
    """Counts come with the write: no other action runs on the parsed rows."""
    write, _, _ = load
    actions = []
    for name in ("collect", "count", "toArrow", "first", "take", "head"):
        monkeypatch.setattr(DataFrame, name, lambda self, *a, n=name: actions.append(n))
    write("x")
    assert actions == []


def test_two_writers_at_once(spark, tmp_path, monkeypatch):
    """The one that comes second makes its change to what the first one wrote."""
    root = str(tmp_path / "root")
    pointer.point_to(spark, root, lambda old: {"a": 1})
    beaten = []

    def slow(old):
        if not beaten:
            beaten.append(pointer.point_to(spark, root, lambda o: o | {"b": 2}))
        return old | {"c": 3}

    pointer.point_to(spark, root, slow)
    assert pointer.current(spark, root) == {"a": 1, "b": 2, "c": 3}


def test_a_killed_run_leaves_the_old_version(spark, small_feed, tmp_path, monkeypatch):
    root = str(tmp_path / "list")
    run(small_feed(), root, "1", TS)
    two = small_feed(Entity=[{"EntityGUID": "E1"}, {"EntityGUID": "E2"}])
    for step in ("run_summary", "point_to", "read_watchlist"):
        with monkeypatch.context() as patch, pytest.raises(Killed):
            patch.setattr(build, step, after(0, getattr(build, step)))
            run(two, root, "2", TS)
        assert latest_version(spark, root) == "1" and read_watchlist(spark, root).count() == 1
    run(two, root, "2", TS)
    assert read_watchlist(spark, root).count() == 2
    assert {r["Count"] for r in read_summary(spark, root).collect()} == {0, 2}
    with pytest.raises(FileExistsError):
        run(two, root, "1", TS)


@pytest.mark.parametrize("split", ["64k", "4m", "128m"])
def test_dense_ids_do_not_follow_the_split_size(spark, split):
    rows = spark.range(40_000, numPartitions=5).where("id % 7 <> 0").select(
        F.col("id").alias("v"), F.sha2(F.col("id").cast("string"), 512).alias("text"))
    n = rows.count()
    numbered = assign_ids(rows, dense=True)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        got = numbered.select("ID", "v").collect()
        assert sorted(r["ID"] for r in got) == list(range(1, n + 1))
        assert len({r["v"] for r in got}) == n
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("dense", [True, False])
def test_a_task_sorts_a_bounded_number_of_rows(spark, tmp_path, monkeypatch, dense):
    from pathlib import Path

    import pyarrow.parquet as pq


    monkeypatch.setattr(build, "SORTED_ROWS", 300)
    monkeypatch.setattr(build, "_LEAST_SPLIT", 1)
    monkeypatch.setattr(sys.modules["screenroll.operators.publish"], "_GROUP_ROWS", 100)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "77m")
    try:
        rows = spark.range(0, 6000, numPartitions=2).select(
            F.concat(F.lit("E"), F.col("id") % 700).alias("EntityGUID"),
            F.sha2(F.col("id").cast("string"), 256).alias("EntityAliasGUID"))
        path = build.write_watchlist(rows, str(tmp_path / "list"), "1", dense)
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "77m"
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    tables = [pq.read_table(f).to_pylist() for f in Path(path).glob("*.parquet")]
    assert max(len(t) for t in tables) <= 500 and sum(len(t) for t in tables) == 6000
    for table in tables:
        order = [(r["EntityGUID"], r["EntityAliasGUID"]) for r in table]
        assert order == sorted(order)
    ids = sorted(r["ID"] for t in tables for r in t)
    assert len(set(ids)) == 6000 and (not dense or ids == list(range(1, 6001)))
