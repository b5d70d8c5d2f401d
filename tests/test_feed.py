"""Feed files written by hand."""

import datetime as dt

import pytest

from screenroll.plans.build import build_watchlist
from screenroll.schemas import FEED
from screenroll.sources import load_audit, read_feed, read_tables, stage_feed


@pytest.fixture
def folder(tmp_path):
    def write(table, *lines, header=None):
        text = "\n".join([header or "|".join(FEED[table]), *lines]) + "\n"
        (tmp_path / f"{table}.txt").write_text(text, encoding="utf-8")
        return str(tmp_path)

    return write


def test_fields_are_taken_as_they_are(spark, folder):
    path = folder("EntityAlias", 'E1|A1|AKA||say "hi|Zoë| x |\\L|||2024-01-31 12:34:56.123',
                  '"E2"|A2|AKA||n|||||""|2024-01-31')
    good, bad = read_feed(spark, path, "EntityAlias")
    rows = {r["EntityGUID"]: r for r in good.collect()}
    assert bad.count() == 0 and set(rows) == {"E1", '"E2"'}
    row = rows["E1"]
    assert (row["EnglishDescription"], row["Name"], row["FirstName"], row["MiddleName"], row["LastName"]) == (
        None, 'say "hi', "Zoë", " x ", "\\L")
    assert row["LastUpdated"] == dt.datetime(2024, 1, 31, 12, 34, 56, 123000)
    assert rows['"E2"']["Suffix"] == '""' and rows['"E2"']["LastUpdated"] == dt.datetime(2024, 1, 31)


def test_bad_rows_are_set_aside(spark, folder):
    path = folder("EntityDOB", "E1|D1|1970|1|2|2024-01-01", "short|row", "E3|D3|1970|1|2|soon",
                  "E4|D4|1970|1|2|2024-01-01|more", "E5|D5|12345678901|1|2|2024-01-01",
                  "E6|D6|1970|1|2|1700-01-01", "E7|D7|1970   |||")
    good, bad = read_feed(spark, path, "EntityDOB")
    assert sorted(r["EntityGUID"] for r in good.collect()) == ["E1", "E7"]
    assert sorted((r["Reason"], r["Line"]) for r in bad.collect()) == [
        ("BirthYear too long", "E5|D5|12345678901|1|2|2024-01-01 00:00:00"),
        ("LastUpdated out of range", "E6|D6|1970|1|2|1700-01-01 00:00:00"),
        ("unreadable", "E3|D3|1970|1|2|soon"),
        ("unreadable", "E4|D4|1970|1|2|2024-01-01|more"),
        ("unreadable", "short|row"),
    ]


@pytest.mark.parametrize("n, fails", [(10, False), (11, True)])
def test_budget_of_bad_rows(spark, folder, tmp_path, n, fails):
    path = folder("EntityDeletes", "E1|2024-01-01", *["x|never"] * n)
    stage = str(tmp_path / "stage")
    if fails:
        with pytest.raises(ValueError, match="EntityDeletes: more than 10"):
            read_feed(spark, path, "EntityDeletes")
        with pytest.raises(ValueError, match="EntityDeletes: more than 10"):
            stage_feed(spark, path, stage, ["EntityDeletes"])
    else:
        assert read_feed(spark, path, "EntityDeletes")[0].count() == 1
        staged, audit = stage_feed(spark, path, stage, ["EntityDeletes"])
        assert [tuple(r) for r in audit.collect()] == [("EntityDeletes", 1, 10)]
    assert read_feed(spark, path, "EntityDeletes", max_errors=None)[1].count() == n


def test_missing_file_gives_no_rows(spark, tmp_path):
    good, bad = read_feed(spark, str(tmp_path), "EntityRemark")
    assert good.columns == list(FEED["EntityRemark"]) and good.count() == 0 and bad.count() == 0


def test_folder_of_part_files(spark, tmp_path):
    (tmp_path / "Country.txt").mkdir()
    for i, line in enumerate(["FR|France", "DE|Germany"]):
        (tmp_path / "Country.txt" / f"part-{i}").write_text(f"tISO|tCountry\n{line}\n")
    assert read_feed(spark, str(tmp_path), "Country")[0].count() == 2


def test_all_tables_have_seventeen_schemas():
    assert len(FEED) == 17 and [len(FEED[t]) for t in ("Entity", "EntityAddress", "EntityAlias")] == [19, 11, 11]


def test_stage_replaces_and_feeds_the_list(spark, folder, tmp_path):
    stage = str(tmp_path / "stage")
    path = folder("Entity", "E1|Individual||N|F||L|||||||||1||2024-01-01|", "E2|x")
    folder("EntityAlias", "E1|A1|AKA||N2|F2||L2|||2024-01-01")
    for _ in range(2):
        staged, audit = stage_feed(spark, path, stage)
    counts = {r["TableName"]: (r["Rows"], r["BadRows"]) for r in audit.collect()}
    assert counts["Entity"] == (1, 1) and counts["EntityAlias"] == (1, 0) and counts["EntityDOB"] == (0, 0)
    assert len(counts) == 17
    assert build_watchlist(staged, "1", "2024-01-01 00:00:00").count() == 2
    assert build_watchlist(read_tables(spark, path), "1", "2024-01-01 00:00:00").count() == 2


def test_load_audit(spark, folder):
    path = folder("EntityDeletes", "E1|2024-01-01", "E2|2024-01-01", "x|never")
    good, bad = read_feed(spark, path, "EntityDeletes")
    audit = load_audit({"EntityDeletes": good}, {"EntityDeletes": bad})
    assert [tuple(r) for r in audit.collect()] == [("EntityDeletes", 2, 1)]
