"""Registered queries: every operator over the whole stand-in tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenroll.functions import encode_entity_type, fit, partial_date, visible_length
from screenroll.operators import (
    assign_ids, best_by_length, consolidate, entity_row_limit, filter_view,
    format_address, format_birth_dates, map_citizenship, map_nationality, master_view,
    merge_national_ids, merge_remarks, merge_sources, merge_text, pep_entities, pivot_other_ids,
    publish, publish_alias, publish_base, run_summary, slot_pivot,
)
from screenroll.plans.build import build_watchlist, read_summary, read_watchlist, run
from screenroll.plans.shared import shared_folder
from screenroll.schemas import FEED, KEY
from screenroll.sources import load_audit, read_feed, stage_feed, staged_tables
from screenroll.sources.buckets import bucket_feed, over_buckets

from .fixtures import FEED_NAMES, feed, view, view_sql
from .oracle import RUN_TS, VERSION, answer

Query = Callable[[SparkSession, str], DataFrame]


def _over(operator: Callable[..., DataFrame], *names: str, **options) -> Query:
    """An operator applied to some stand-in tables."""
    return lambda spark, d: operator(*[view(spark, d, n) for n in names], **options)


def _profiles(spark: SparkSession, d: str, **options) -> DataFrame:
    return consolidate(feed(spark, d), **options)


def _watchlist(spark: SparkSession, d: str, **options) -> DataFrame:
    return build_watchlist(feed(spark, d), VERSION, RUN_TS, **options)


def _scratch(spark: SparkSession) -> str:
    """A new folder in the shared one."""
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def _feed_file(spark: SparkSession, d: str) -> str:
    """The address table written as a feed file, with unreadable and overlong rows."""
    orders = spark.read.parquet(f"{d}/orders.parquet")
    key, date = F.col("o_orderkey"), F.col("o_orderdate").cast("date").cast("string")
    none = F.lit(None).cast("string")
    rows = orders.select(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("EntityGUID"),
        F.concat(F.lit("A"), key.cast("string")).alias("EntityAddressGUID"),
        F.when(key % 20 == 0, "Place Of Birth").otherwise("Mailing").alias("AddressTypeDesc"),
        F.when(key % 7 != 0, F.col("o_orderpriority")).alias("Address1"),
        F.concat(F.lit('the "'), (key % 1000).cast("string"), F.lit("\\")).alias("Address2"),
        F.when(key % 101 == 0, F.repeat(F.lit("x"), 201)).otherwise("Paris").alias("City"),
        none.alias("StateProvinceRegion"), none.alias("PostalCode"), none.alias("Country"),
        F.concat(F.lit("N"), (key % 27).cast("string")).alias("ISOStandard"),
        F.when(key % 97 == 0, "soon").otherwise(F.concat(date, F.lit(" 10:20:30.5")))
        .alias("LastUpdated"),
    )
    folder = _scratch(spark)
    rows.write.option("sep", "|").option("header", True).option("quote", "").option(
        "escape", ""
    ).option("emptyValue", "").csv(f"{folder}/EntityAddress.txt")
    return folder


FEED_GOOD_SQL = """
    select 'C'||o_custkey EntityGUID, 'A'||o_orderkey EntityAddressGUID,
      case when o_orderkey%20=0 then 'Place Of Birth' else 'Mailing' end AddressTypeDesc,
      case when o_orderkey%7<>0 then o_orderpriority end Address1,
      'the "'||(o_orderkey%1000)||'\\' Address2, 'Paris' City,
      cast(null as varchar) StateProvinceRegion, cast(null as varchar) PostalCode,
      cast(null as varchar) Country, 'N'||(o_orderkey%27) ISOStandard,
      cast(o_orderdate as date)+interval '10 hours 20 minutes 30.5 seconds' LastUpdated
    from orders where o_orderkey%97<>0 and o_orderkey%101<>0"""

FEED_BAD_SQL = """
    select 'EntityAddress' "Table", case when o_orderkey%97=0 then 'unreadable'
        else 'City too long' end "Reason", count(*) "Rows"
    from orders where o_orderkey%97=0 or o_orderkey%101=0 group by 1, 2"""


# Columns that the stand-in of each feed table has.
STAND_IN_COLUMNS = {
    "Country": "tISO tCountry",
    "Entity": "EntityGUID EntityTypeDesc Gender Name FirstName MiddleName LastName Title EntityID",
    "EntityAddress": "EntityGUID AddressTypeDesc Address1 Address2 City ISOStandard",
    "EntityAlias": "EntityGUID EntityAliasGUID AliasTypeDesc Name FirstName MiddleName LastName",
    "EntityCountryAssociation": "EntityGUID AssociationTypeDesc AdministrativeUnitName ISOStandard",
    "EntityDOB": "EntityGUID BirthYear BirthMonth BirthDay",
    "EntityEnforcement": "EntityGUID SourceName",
    "EntityIdentification": "EntityGUID IdentificationTypeDesc IdentificationNumber",
    "EntityRemark": "EntityGUID Remark",
    "EntitySanction": "EntityGUID SourceName",
    "EntitySourceItem": "EntityGUID SourceURI",
}
_BREAKS = "\n\r|"


def _staged(spark: SparkSession, d: str) -> str:
    """All stand-in tables written as feed files (compressed) and loaded; the folder of the load."""
    folder, target = _scratch(spark), _scratch(spark)
    for table, rows in feed(spark, d).items():
        texts = {c: F.translate(F.col(c), _BREAKS, "   ") for c in STAND_IN_COLUMNS[table].split()}
        columns = [texts.get(c, F.lit(None).cast("string")).alias(c) for c in FEED[table]]
        rows.select(*columns).write.option("sep", "|").option("header", True).option("quote", "").option(
            "escape", "").option("emptyValue", "").option("ignoreLeadingWhiteSpace", False).option(
            "ignoreTrailingWhiteSpace", False).option("compression", "gzip").csv(f"{folder}/{table}.txt")
    stage_feed(spark, folder, target)
    return target


def _staged_rows(spark: SparkSession, d: str) -> DataFrame:
    tables = staged_tables(spark, _staged(spark, d))
    lines = [
        tables[table].select(F.lit(table).alias("Table"), F.concat_ws("|", *[
            F.coalesce(c, F.lit("")) for c in columns.split()]).alias("Line"))
        for table, columns in STAND_IN_COLUMNS.items()
    ]
    return reduce(DataFrame.unionByName, lines)


#: The stand-ins as they come out of feed files: an empty field is NULL.
STAGED = {
    view: "select " + ", ".join(
        f"nullif(translate({c}, chr(10)||chr(13)||'|', '   '), '') {c}" for c in STAND_IN_COLUMNS[table].split())
    + f" from ({view_sql(view)})"
    for table, view in FEED_NAMES.items()
}

STAGED_ROWS_SQL = " union all ".join(
    f"""select '{table}' "Table", concat_ws('|', """
    + ", ".join(f"coalesce({c}, '')" for c in STAND_IN_COLUMNS[table].split()) + f""") "Line" from ({STAGED[view]})"""
    for table, view in FEED_NAMES.items()
)


def _written(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """From feed files to the stored list and its summary."""
    root = _scratch(spark)
    run(staged_tables(spark, _staged(spark, d)), root, VERSION, RUN_TS, dense_ids=True)
    return read_watchlist(spark, root), read_summary(spark, root)


def _written_ids(spark: SparkSession, d: str) -> DataFrame:
    return _written(spark, d)[0].agg(
        F.count("*").alias("n"), F.count_distinct("ID").alias("distinct_ids"),
        F.min("ID").alias("first_id"), F.max("ID").alias("last_id"))


def _read_good(spark: SparkSession, d: str) -> DataFrame:
    return read_feed(spark, _feed_file(spark, d), "EntityAddress", max_errors=None)[0]


def _read_bad(spark: SparkSession, d: str) -> DataFrame:
    bad = read_feed(spark, _feed_file(spark, d), "EntityAddress", max_errors=None)[1]
    return bad.groupBy("Table", "Reason").agg(F.count("*").alias("Rows"))


FEED_COUNTS_SQL = """
    select 'EntityAddress' TableName, count(*) filter (where not bad) "Rows",
      count(*) filter (where bad) BadRows
    from (select o_orderkey%97=0 or o_orderkey%101=0 bad from orders)"""


def _staged_audit(spark: SparkSession, d: str) -> DataFrame:
    source, target = _feed_file(spark, d), _scratch(spark)
    return stage_feed(spark, source, target, ["EntityAddress"], max_errors=1 << 60)[1]


def _audit_with_bad_rows(spark: SparkSession, d: str) -> DataFrame:
    good, bad = read_feed(spark, _feed_file(spark, d), "EntityAddress", max_errors=None)
    return load_audit({"EntityAddress": good}, {"EntityAddress": bad})


def _text_functions(spark: SparkSession, d: str) -> DataFrame:
    remark = view(spark, d, "remark")
    return remark.select(
        KEY, fit(F.col("Remark"), 20).alias("Start"), visible_length(F.col("Remark")).alias("Chars")
    )


def _partial_dates(spark: SparkSession, d: str) -> DataFrame:
    parts = [F.col(c) for c in ("BirthYear", "BirthMonth", "BirthDay")]
    return view(spark, d, "dob").select(
        KEY, partial_date(*parts).alias("DOB"), partial_date(*parts, "year").alias("DOBOrYear")
    )


def _id_facts(spark: SparkSession, d: str, dense: bool) -> DataFrame:
    facts = assign_ids(_watchlist(spark, d), dense).agg(
        F.count("*").alias("n"), F.countDistinct("ID").alias("distinct_ids"),
        F.min("ID").alias("first_id"), F.max("ID").alias("last_id"),
    )
    return facts if dense else facts.select("n", "distinct_ids")


_LIMITED = {"kept_entity": "select * from entity order by EntityGUID limit 500"}

# Name -> (query, DuckDB answer).
REGISTRY: dict[str, tuple[Query, str]] = {
    "read_feed": (_read_good, FEED_GOOD_SQL),
    "read_feed_bad_rows": (_read_bad, FEED_BAD_SQL),
    "stage_feed": (_staged_audit, FEED_COUNTS_SQL),
    "stage_feed_rows": (_staged_rows, STAGED_ROWS_SQL),
    "run_written_list": (lambda spark, d: _written(spark, d)[0].drop("ID"), answer("published", STAGED)),
    "run_written_ids": (_written_ids, answer("id_facts", STAGED)),
    "run_written_summary": (lambda spark, d: _written(spark, d)[1], answer("summary_rows", STAGED)),
    "load_audit_bad_rows": (_audit_with_bad_rows, FEED_COUNTS_SQL),
    "load_audit": (
        lambda spark, d: load_audit(feed(spark, d)),
        "with " + ", ".join(f"{v} as ({view_sql(v)})" for v in FEED_NAMES.values()) + " "
        + " union all ".join(
            f"select '{n}' TableName, count(*) \"Rows\", 0 BadRows from {v}"
            for n, v in FEED_NAMES.items()
        ),
    ),
    "fit_text": (
        _text_functions,
        answer("t", {"t": """select EntityGUID, substring(Remark,1,20) "Start",
            coalesce(length(rtrim(Remark, ' ')),0) Chars from remark"""}),
    ),
    "partial_date": (
        _partial_dates,
        answer("t", {"t": """select EntityGUID,
            case when BirthMonth='' and BirthDay='' then BirthYear
              else BirthYear||'-'||BirthMonth||'-'||BirthDay end DOB,
            case when coalesce(BirthMonth,'')='' and BirthDay='' then BirthYear
              else BirthYear||'-'||coalesce(BirthMonth,'')||'-'||BirthDay end DOBOrYear from dob"""}),
    ),
    "encode_entity_type": (
        lambda spark, d: view(spark, d, "entity").select(
            KEY, encode_entity_type(F.col("EntityTypeDesc")).alias("Code")
        ),
        answer("t", {"t": """select EntityGUID, case EntityTypeDesc when 'Individual' then '3'
            when 'Country' then '1' when 'Organization' then '9' when 'Vessel' then '4' else '6' end
            Code from entity"""}),
    ),
    "merge_text": (
        lambda spark, d: merge_text(
            view(spark, d, "address"), KEY, {"City": None, "Address1": None, "AddressTypeDesc": None},
            sep=", ",
        ),
        answer("t", {"t": "select EntityGUID, " + ", ".join(
            f"coalesce(string_agg(distinct {c}, ', ' order by {c}),'') {c}"
            for c in ("City", "Address1", "AddressTypeDesc")) + " from address group by 1"}),
    ),
    "merge_text_cut": (
        lambda spark, d: merge_text(view(spark, d, "address"), KEY, {"City": 13, "Address2": 9}),
        answer("t", {"t": "select EntityGUID, " + ", ".join(
            f"left(string_agg(distinct {c}, '; ' order by {c}),{w}) {c}"
            for c, w in (("City", 13), ("Address2", 9))) + " from address group by 1"}),
    ),
    "merge_sources": (_over(merge_sources, "srcitem"), answer("src_new")),
    "merge_remarks": (_over(merge_remarks, "remark"), answer("remark_new")),
    "merge_remarks_null_if_single": (
        _over(merge_remarks, "remark", null_if_single=True), answer("remark_null")),
    "merge_national_ids": (_over(merge_national_ids, "ident"), answer("national_new")),
    "merge_national_ids_null_if_single": (
        _over(merge_national_ids, "ident", null_if_single=True), answer("national_null")),
    "best_by_length": (
        lambda spark, d: best_by_length(
            view(spark, d, "address").where("AddressTypeDesc <> 'Place Of Birth'")
            .drop("AddressTypeDesc"),
            KEY, ["Address1", "Address2", "City", "ISOStandard"]),
        answer("address_best"),
    ),
    "best_by_length_one": (
        lambda spark, d: best_by_length(
            view(spark, d, "address").where("AddressTypeDesc <> 'Place Of Birth'")
            .drop("AddressTypeDesc"),
            KEY, ["Address1", "Address2", "City", "ISOStandard"], ties="one"),
        answer("address_one"),
    ),
    "format_address": (_over(format_address, "address", "country"), answer("address_new")),
    "format_address_one": (
        _over(format_address, "address", "country", ties="one"),
        answer("address_new", {"address_best": "select * from address_one"})),
    "format_address_truncate": (
        lambda spark, d: format_address(
            view(spark, d, "address").withColumn("City", F.repeat("City", 9)),
            view(spark, d, "country"), overlong="truncate"),
        answer("t", {"t": "select * replace (left(City, 50) as City, left(POB, 50) as POB) from address_new",
                     "address": "select * replace (repeat(City, 9) as City) from (" + view_sql("address") + ")"})),
    "map_citizenship": (_over(map_citizenship, "assoc", "country"), answer("citizenship_new")),
    "map_nationality": (_over(map_nationality, "assoc", "country"), answer("nat")),
    "pep_entities": (_over(pep_entities, "assoc"), answer("pep")),
    "slot_pivot": (
        lambda spark, d: slot_pivot(
            view(spark, d, "alias"), KEY, [F.col("Name").asc()],
            {"Name": "Name{i}", "EntityAliasGUID": "Alias{i}"}, 3),
        answer("t", {"t": "select EntityGUID, " + ", ".join(
            f"max({c}) filter (where slot={i}) {n}{i}" for i in (1, 2, 3)
            for c, n in (("Name", "Name"), ("EntityAliasGUID", "Alias")))
            + " from (select *, row_number() over (partition by EntityGUID order by Name) slot"
            + " from alias) group by 1"}),
    ),
    "format_birth_dates": (_over(format_birth_dates, "dob"), answer("dob_new")),
    "format_birth_dates_by_date": (
        _over(format_birth_dates, "dob", order="date", null_parts="year"), answer("dob_by_date")),
    "pivot_other_ids": (_over(pivot_other_ids, "ident"), answer("ident_new")),
    "entity_row_limit": (
        _over(entity_row_limit, "entity", n=500), answer("kept_entity", _LIMITED)),
    "consolidate": (_profiles, answer("consolidated")),
    "consolidate_non_pep_rows": (
        lambda spark, d: _profiles(spark, d).where(
            F.coalesce(F.col("WLType") != "PEP", F.lit(True))),
        answer("t", {"t": "select * from consolidated where WLType is distinct from 'PEP'"}),
    ),
    "consolidate_dedup": (
        lambda spark, d: _profiles(spark, d, dedup=True), answer("consolidated_dedup")),
    "consolidate_row_limit": (
        lambda spark, d: _profiles(spark, d, row_limit=500), answer("consolidated", _LIMITED)),
    "publish_base": (
        lambda spark, d: publish_base(_profiles(spark, d), VERSION, RUN_TS), answer("base_rows")),
    "publish_alias": (
        lambda spark, d: publish_alias(_profiles(spark, d), view(spark, d, "alias"), VERSION, RUN_TS),
        answer("alias_rows")),
    "publish": (
        lambda spark, d: publish(_profiles(spark, d), view(spark, d, "alias"), VERSION, RUN_TS),
        answer("published")),
    "build_watchlist": (_watchlist, answer("published")),
    "build_watchlist_bucketed": (
        lambda spark, d: over_buckets(
            build_watchlist, bucket_feed(feed(spark, d), _scratch(spark), 8), VERSION, RUN_TS),
        answer("published")),
    "build_watchlist_dedup": (
        lambda spark, d: _watchlist(spark, d, dedup=True),
        answer("published", {
            "consolidated": "select * from nonpep_rows union select * from pep_rows"})),
    "assign_ids": (
        lambda spark, d: _id_facts(spark, d, False),
        answer("t", {"t": "select n, distinct_ids from id_facts"})),
    "assign_ids_dense": (lambda spark, d: _id_facts(spark, d, True), answer("id_facts")),
    "master_view": (
        lambda spark, d: master_view(assign_ids(_watchlist(spark, d))).drop("ID"),
        answer("master_rows")),
    "filter_view": (
        lambda spark, d: filter_view(assign_ids(_watchlist(spark, d))).drop("ID"),
        answer("name_search")),
    "run_summary": (
        lambda spark, d: run_summary(_watchlist(spark, d), RUN_TS), answer("summary_rows")),
}
