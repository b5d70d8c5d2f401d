"""Stand-ins for the feed tables, as projections of the driver's tables.

One text serves both engines; ``{orders}`` and the like are replaced by the
table of the engine. The projections are fixed values agreed in FIXTURES.md.
"""

from __future__ import annotations

from string import Formatter

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "country": """
        select 'N'||cast(n_nationkey as string) tISO, n_name tCountry from {nation}""",
    "entity": """
        select 'C'||cast(c_custkey as string) EntityGUID,
          case c_mktsegment when 'HOUSEHOLD' then 'Individual' when 'MACHINERY' then 'Organization'
            when 'FURNITURE' then 'Vessel' when 'BUILDING' then 'Country' else 'Aircraft' end
            EntityTypeDesc,
          case when c_nationkey%3=0 then 'Male' when c_nationkey%3=1 then 'Female' end Gender,
          c_name Name, substring(c_name,1,8) FirstName,
          case when c_custkey%2=0 then 'M'||cast(c_custkey as string) end MiddleName,
          substring(c_name,10,9) LastName, case when c_custkey%5=0 then 'Dr' end Title,
          cast(c_custkey as string) EntityID
        from {customer}""",
    "address": """
        select 'C'||cast(o_custkey as string) EntityGUID,
          case when o_orderkey%20=0 then 'Place Of Birth' when o_orderkey%31=0 then null
            when o_orderpriority='1-URGENT' then 'Residence' else 'Mailing' end AddressTypeDesc,
          case when o_orderkey%7=0 then null else o_orderpriority end Address1,
          'U'||cast(o_orderkey%1000 as string) Address2,
          'City'||cast(o_orderkey%13 as string) City,
          'N'||cast(o_orderkey%27 as string) ISOStandard
        from {orders}""",
    "assoc": """
        select 'C'||cast(o_custkey as string) EntityGUID,
          case when o_orderkey%40=0 then 'PEP' when o_orderkey%12=1 then 'Nationality'
            when o_orderkey%9 in (2,3) then 'Citizenship' else 'Residence' end AssociationTypeDesc,
          'NATION_'||cast(o_orderkey%4 as string) AdministrativeUnitName,
          'N'||cast(o_orderkey%27 as string) ISOStandard
        from {orders}""",
    "dob": """
        select 'C'||cast(o_custkey as string) EntityGUID,
          cast(year(o_orderdate) as string) BirthYear,
          case when o_orderkey%11=0 then '' when o_orderkey%13=0 then null
            else cast(month(o_orderdate) as string) end BirthMonth,
          case when o_orderkey%11=0 then '' when o_orderkey%10=0 then '31'
            else cast(day(o_orderdate) as string) end BirthDay
        from {orders}""",
    "ident": """
        select 'C'||cast(o_custkey as string) EntityGUID,
          case when o_custkey%3<>1 and l_partkey%4=0 then 'National Id - '||l_linestatus
            when l_returnflag='A' then 'Passport' when l_returnflag='N' then 'Driving Licence'
            else 'Tax No' end IdentificationTypeDesc,
          case when l_suppkey%10=0 then null
            else 'ID'||cast(1000000+l_partkey as string)||'-'||cast(l_orderkey as string) end
            IdentificationNumber
        from {lineitem} join {orders} on l_orderkey=o_orderkey""",
    "remark": """
        select 'C'||cast(doc_id-doc_id%4 as string) EntityGUID,
          case when doc_id%92<4 then '' when doc_id%29=0 then null else text end Remark
        from {documents}""",
    "srcitem": """
        select 'C'||cast(page_id-page_id%3 as string) EntityGUID,
          case when page_id%48<3 then '' else url end SourceURI
        from {pages}
        union all
        select 'C'||cast(page_id-page_id%3 as string), url from {pages} where page_id%4=3""",
    "enf": """
        select 'C'||cast(p_partkey-p_partkey%2 as string) EntityGUID,
          case when p_partkey%10=4 then 'PEP' else 'ENF-'||p_brand end SourceName
        from {part}""",
    "san": """
        select 'C'||cast(s_suppkey*3 as string) EntityGUID,
          case when s_suppkey%2=1 then null else 'SAN-'||s_name end SourceName
        from {supplier}""",
    "alias": """
        select 'C'||cast(o_custkey as string) EntityGUID,
          'A'||cast(o_orderkey as string) EntityAliasGUID,
          case o_orderkey%12 when 0 then 'Acronym' when 1 then 'Call Sign'
            when 2 then 'Chinese Commercial Code (CCC)' when 3 then 'Native Script For Alias'
            when 4 then 'Native Script For Entity' when 5 then null when 6 then 'Maiden Name' else 'AKA' end
            AliasTypeDesc,
          'Alias '||cast(o_orderkey as string) Name,
          case when o_orderkey%9=0 then null else 'AF' end FirstName,
          cast(null as string) MiddleName, 'AL'||cast(o_orderkey as string) LastName
        from {orders}""",
}

FEED_NAMES = {
    "Country": "country", "Entity": "entity", "EntityAddress": "address",
    "EntityCountryAssociation": "assoc", "EntityDOB": "dob", "EntityIdentification": "ident",
    "EntityRemark": "remark", "EntitySourceItem": "srcitem", "EntityEnforcement": "enf",
    "EntitySanction": "san", "EntityAlias": "alias",
}

BASE = ["nation", "customer", "orders", "lineitem", "part", "supplier", "documents", "pages"]


def view_sql(name: str) -> str:
    """Projection text over views of the plain table names, for DuckDB."""
    return VIEWS[name].format(**{t: t for t in BASE})


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The driver's tables the stand-ins are made of."""
    return {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in BASE}


def view(
    spark: SparkSession, sf_dir: str, name: str, raw: dict[str, DataFrame] | None = None
) -> DataFrame:
    """A stand-in table over the Parquet files of ``sf_dir``."""
    used = {t for _, t, _, _ in Formatter().parse(VIEWS[name]) if t}
    raw = raw or {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used}
    return spark.sql(VIEWS[name], **{t: raw[t] for t in used})


def feed(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All stand-in tables under their feed names."""
    raw = raw_tables(spark, sf_dir)
    return {feed_name: view(spark, sf_dir, v, raw) for feed_name, v in FEED_NAMES.items()}
