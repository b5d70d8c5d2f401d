"""Field operators on hand-made rows, rule by rule."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from screenroll.functions import encode_entity_type, fit, full_name, partial_date, safe_date
from screenroll.operators import (
    best_by_length, format_address, format_birth_dates, map_citizenship, map_nationality,
    merge_national_ids, merge_remarks, merge_sources, merge_text, pep_entities, pivot_other_ids,
    slot_pivot,
)
from screenroll.plans.skew import Keys

KEY = "EntityGUID"


def keys_of(spark, *keys):
    """Heavy keys as the count of the skew policy gives them."""
    return Keys(spark.createDataFrame([(k, 1) for k in keys], "_key string, _n long"), len(keys), 1)


def one(spark, expression, **values):
    fields = ", ".join(f"{k} string" for k in values) or "x string"
    data = [tuple(values.values()) or (None,)]
    return spark.createDataFrame(data, fields).select(expression.alias("r")).first()["r"]


# --- scalar expressions ---------------------------------------------------------------


def test_fit_cuts_or_fails(spark):
    assert one(spark, fit(F.col("v"), 3), v="abcd") == "abc"
    assert one(spark, fit(F.col("v"), 3), v=None) is None
    assert one(spark, fit(F.col("v"), 3, "error"), v="abc") == "abc"
    assert one(spark, fit(F.col("v"), 3, "error"), v="abc   ") == "abc"
    with pytest.raises(Exception, match="v is longer than 3"):
        one(spark, fit(F.col("v"), 3, "error", "v"), v="abcd")
    with pytest.raises(ValueError):
        fit(F.col("v"), 3, "ignore")


def test_full_name_keeps_the_blank(spark):
    assert one(spark, full_name(F.col("a"), F.col("b")), a="Ann", b=None) == "Ann "
    assert one(spark, full_name(F.col("a"), F.col("b")), a=None, b="Bo") == " Bo"


@pytest.mark.parametrize("parts, null, year", [
    (("1970", "9", "1"), "1970-9-1", "1970-9-1"),
    (("1970", "", " "), "1970", "1970"),
    (("1970", None, "1"), None, "1970--1"),
    (("1970", None, None), None, "1970"),
    (("1970", "5", ""), "1970-5-", "1970-5-"),
    ((None, "5", "1"), None, None),
])
def test_partial_date(spark, parts, null, year):
    named = dict(zip("ymd", parts))
    columns = [F.col(c) for c in "ymd"]
    assert one(spark, partial_date(*columns), **named) == null
    assert one(spark, partial_date(*columns, null_parts="year"), **named) == year


@pytest.mark.parametrize("text, date", [
    ("1970-9-1", dt.datetime(1970, 9, 1)),
    ("1970-2-31", None), ("1970-5", None), ("1752-12-31", None), ("1753-1-1", dt.datetime(1753, 1, 1)),
    ("19705-2-1", None), ("x", None), (None, None),
])
def test_safe_date(spark, text, date):
    assert one(spark, safe_date(F.col("t")), t=text) == date


def test_entity_type_codes(spark):
    codes = {"Individual": "3", "Country": "1", "Organization": "9", "Vessel": "4", "Boat": "6", None: "6"}
    for label, code in codes.items():
        assert one(spark, encode_entity_type(F.col("t")), t=label) == code


# --- text merge -----------------------------------------------------------------------


def test_merge_orders_dedupes_and_drops_blanks(spark, rows_of):
    df = spark.createDataFrame(
        [("a", ""), ("a", "y"), ("a", "x"), ("a", "x"), ("b", ""), ("b", None), ("c", None), (None, "z")],
        "k string, v string")
    assert rows_of(merge_text(df, "k", {"v": None})) == [("a", "x; y"), ("b", ""), ("c", "")]
    assert rows_of(merge_text(df, "k", {"v": 3})) == [("a", "x; "), ("b", ""), ("c", "")]
    single = merge_text(df, "k", {"v": 9}, null_if_single=True)
    assert rows_of(single) == [("a", "x; y"), ("b", ""), ("c", None)]


def test_merge_two_columns_with_own_widths(spark, rows_of):
    df = spark.createDataFrame(
        [("a", "t2", "n1"), ("a", "t1", "n2"), ("a", "t1", None), ("b", None, "n")],
        "k string, t string, n string")
    assert rows_of(merge_text(df, "k", {"t": 3, "n": 5})) == [("a", "t1;", "n1; n"), ("b", "", "n")]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.one_of(st.none(), st.text("xy;", max_size=3))),
                min_size=1, max_size=14),
       st.integers(1, 12), st.randoms())
def test_merge_equals_plain_definition(spark, rows, width, random):
    shuffled = list(rows)
    random.shuffle(shuffled)
    df = spark.createDataFrame(shuffled, "k string, v string")
    expected = {
        k: "; ".join(sorted({v for kk, v in rows if kk == k and v}))[:width] for k, _ in rows
    }
    for heavy in (None, keys_of(spark, "a")):
        got = {r["k"]: r["v"] for r in merge_text(df, "k", {"v": width}, heavy=heavy, salts=3).collect()}
        assert got == expected


def test_sources_have_no_width(table, rows_of):
    links = [f"http://x/{i:04d}" for i in range(900)]
    t = table("EntitySourceItem", *[{KEY: "E", "SourceURI": u} for u in links * 2])
    assert rows_of(merge_sources(t)) == [("E", "; ".join(links))]


def test_remark_is_cut_before_and_after_merging(table, rows_of):
    t = table("EntityRemark", {KEY: "E", "Remark": "a" * 5000}, {KEY: "E", "Remark": "a" * 4000 + "b"},
              {KEY: "F", "Remark": "x" * 3999}, {KEY: "F", "Remark": "y"},
              {KEY: "G", "Remark": ""}, {KEY: "G", "Remark": None}, {KEY: None, "Remark": "lost"})
    assert rows_of(merge_remarks(t)) == [("E", "a" * 4000), ("F", "x" * 3999 + ";"), ("G", "")]


def test_national_ids_are_cut_after_joining(table, rows_of):
    n = ["A" * 30, "B" * 30]
    t = table("EntityIdentification",
              {KEY: "E", "IdentificationTypeDesc": "National Id - X", "IdentificationNumber": n[1]},
              {KEY: "E", "IdentificationTypeDesc": "National Id", "IdentificationNumber": n[0]},
              {KEY: "E", "IdentificationTypeDesc": "Passport", "IdentificationNumber": "P"},
              {KEY: "F", "IdentificationTypeDesc": "National Id", "IdentificationNumber": None},
              {KEY: "G", "IdentificationTypeDesc": None, "IdentificationNumber": "1"})
    assert rows_of(merge_national_ids(t), KEY, "IdentificationNumber", "IdentificationTypeDesc") == [
        ("E", f"{n[0]}; {'B' * 18}", "National Id; National Id - X"), ("F", "", "National Id")]
    assert rows_of(merge_national_ids(t, null_if_single=True).where("EntityGUID='F'"),
                   "IdentificationNumber", "IdentificationTypeDesc") == [(None, "National Id")]


# --- addresses ------------------------------------------------------------------------


def address(key, a1=None, kind="Home", city=None, iso=None, a2=None):
    return {KEY: key, "AddressTypeDesc": kind, "Address1": a1, "Address2": a2, "City": city,
            "ISOStandard": iso}


@pytest.fixture(scope="module")
def country(table):
    return table("Country", {"tISO": "FR", "tCountry": "France"}, {"tISO": "DE", "tCountry": "Germany"})


def test_longest_address_wins_and_ties_stay(table, country, rows_of):
    t = table("EntityAddress", address("E", "abc"), address("E", "abd"), address("E", "x"),
              address("F", "ab       "), address("F", "abc"))
    assert rows_of(format_address(t, country), KEY, "AddressLine1") == [
        ("E", "abc"), ("E", "abd"), ("F", "abc")]
    assert rows_of(format_address(t, country, ties="one"), KEY, "AddressLine1") == [
        ("E", "abc"), ("F", "abc")]
    with pytest.raises(ValueError):
        best_by_length(t, KEY, ["Address1"], ties="some")


def test_birth_places_multiply_and_need_an_address(table, country, rows_of):
    t = table("EntityAddress", address("E", "a", city="Lyon", iso="FR"),
              address("E", kind="Place Of Birth", city="Rom"), address("E", kind="Place Of Birth", city="Bonn"),
              address("F", kind="Place Of Birth", city="Oslo"), address("G", "typeless", kind=None),
              address("H", "b", iso="XX"), address(None, "nobody"))
    assert rows_of(format_address(t, country), KEY, "AddressLine1", "City", "POB", "Country") == [
        ("E", "a", "Lyon", "Bonn", "France"), ("E", "a", "Lyon", "Rom", "France"),
        ("H", "b", None, None, None)]


def test_overlong_address(table, country, rows_of):
    t = table("EntityAddress", address("E", "a" * 256, city="c" * 60))
    with pytest.raises(Exception, match="longer than"):
        format_address(t, country).collect()
    got = rows_of(format_address(t, country, overlong="truncate"), "AddressLine1", "City")
    assert got == [("a" * 255, "c" * 50)]


def test_best_by_length_is_the_same_for_heavy_keys(spark, table, rows_of):
    t = table("EntityAddress", *[address(k, "a" * (i % 5)) for k in "EFG" for i in range(25)])
    plain = best_by_length(t, KEY, ["Address1"])
    assert rows_of(best_by_length(t, KEY, ["Address1"], heavy=keys_of(spark, "E", "G"))) == rows_of(plain)
    assert plain.count() == 15


# --- countries ------------------------------------------------------------------------


def link(key, kind, iso=None, unit=None):
    return {KEY: key, "AssociationTypeDesc": kind, "ISOStandard": iso, "AdministrativeUnitName": unit}


def test_citizenship(table, country, rows_of):
    t = table("EntityCountryAssociation",
              link("E", "Citizenship", "FR", "b"), link("E", "Citizenship", "FR", "b"),
              link("E", "Citizenship", "DE", "b"), link("E", "Citizenship", "DE", "a"),
              link("E", "Citizenship", "XX", "a"),
              link("F", "Citizenship", "XX", None), link("F", "Citizenship", None, None),
              link("G", "Citizenship", "FR", None), link("G", "Citizenship", "DE", "a"),
              link("H", "Residence", "FR", "z"), link(None, "Citizenship", "FR", "z"))
    assert rows_of(map_citizenship(t, country)) == [
        ("E", "DE", "Germany"), ("E", "FR", "France"), ("F", "XX", None), ("F", None, None),
        ("G", "DE", "Germany")]


def test_nationality_and_exposure(table, country, rows_of):
    t = table("EntityCountryAssociation", link("E", "Nationality", "FR"), link("E", "Nationality", "FR"),
              link("E", "Nationality", "XX"), link("E", "PEP"), link("E", "PEP"), link(None, "PEP"))
    assert rows_of(map_nationality(t, country)) == [("E", "France"), ("E", "France")]
    assert rows_of(pep_entities(t)) == [("E",)]


# --- slots ----------------------------------------------------------------------------


def born(key, *parts):
    return {KEY: key, **dict(zip(("BirthYear", "BirthMonth", "BirthDay"), parts))}


def test_birth_dates_rank_as_text(table, rows_of):
    t = table("EntityDOB", born("E", "1970", "10", "1"), born("E", "1970", "9", "1"),
              born("E", "1970", "9", "1"), born("E", "1970", "2", "31"), born("E", "1752", "12", "31"),
              born("E", "1960", "1", "1"), born("F", "1980", "", ""), born("F", "1970", "", ""),
              born("G", "1980", None, "1"))
    assert rows_of(format_birth_dates(t)) == [
        ("E", "1970-9-1", None, dt.datetime(1970, 10, 1), dt.datetime(1960, 1, 1)),
        ("F", "1980", None, None, None), ("G", None, None, None, None)]
    by_date = format_birth_dates(t, order="date", null_parts="year")
    assert rows_of(by_date) == [
        ("E", "1970-10-1", dt.datetime(1970, 9, 1), dt.datetime(1960, 1, 1), None),
        ("F", "1980", None, None, None), ("G", "1980--1", None, None, None)]


def ident(key, kind, number):
    return {KEY: key, "IdentificationTypeDesc": kind, "IdentificationNumber": number}


def test_five_id_slots(table, rows_of):
    t = table("EntityIdentification", *[ident("E", "P", f"{i}") for i in range(1, 7)],
              ident("F", "Visa", "7"), ident("F", "Card", "7"), ident("F", None, "7" * 60),
              ident("F", "P" * 90, None))
    got = {r[KEY]: r.asDict() for r in pivot_other_ids(t).collect()}
    assert [got["E"][f"IdNo{i}"] for i in range(1, 6)] == ["6", "5", "4", "3", "2"]
    assert [got["F"][f"IdNo{i}"] for i in range(1, 6)] == ["7" * 50, "7", "7", None, None]
    assert [got["F"][f"IdOtherInfo{i}"] for i in range(1, 6)] == [None, "Card", "Visa", "P" * 85, None]


def test_national_id_hides_the_others(table, rows_of):
    t = table("EntityIdentification", ident("E", "Passport", "9"), ident("E", "National Id - F", None),
              ident("F", "Passport", "8"), ident(None, "Passport", "7"))
    assert rows_of(pivot_other_ids(t), KEY, "IdNo1") == [("F", "8")]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 9)), min_size=1, max_size=20),
       st.integers(1, 4))
def test_slot_pivot_has_one_row_per_key(spark, rows, n):
    df = spark.createDataFrame(rows, "k string, v int")
    got = slot_pivot(df, "k", [F.col("v").desc()], {"v": "v{i}"}, n).collect()
    assert {r["k"] for r in got} == {k for k, _ in rows} and len(got) == len({k for k, _ in rows})
    for r in got:
        best = sorted((v for k, v in rows if k == r["k"]), reverse=True)[:n]
        assert [r[f"v{i}"] for i in range(1, n + 1)] == best + [None] * (n - len(best))


def test_a_column_without_width_leaves_the_bound_of_the_others(spark):
    rows = spark.range(400).selectExpr("'a' k", "lpad(id, 3, '0') v", "cast(id % 3 as string) w")
    got = merge_text(rows, "k", {"v": 10, "w": None}).collect()[0]
    assert (got["v"], got["w"]) == ("000; 001; ", "0; 1; 2")
    plan = merge_text(rows, "k", {"v": 10, "w": None})._jdf.queryExecution().toString()
    assert "row_number" in plan
