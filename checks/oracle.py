"""Answers in DuckDB SQL, written independently of the operators.

Each step is one common table expression; ``answer`` puts the needed ones in
front of a final select.
"""

from __future__ import annotations

import re

from .fixtures import VIEWS, view_sql

RUN_TS = "2024-05-17 08:30:00"
VERSION = "7"

# Alias types that give no list row.
EXCLUDED = ", ".join(f"'{t}'" for t in (
    "Acronym",
    "Call Sign",
    "Chinese Commercial Code (CCC)",
    "Native Script For Alias",
    "Native Script For Entity"))

IDS = [f"{c}{i}" for i in range(1, 6) for c in ("IdOtherInfo", "IdNo")]
ATTRIBUTES = (
    "ReferenceID, EntityType, Gender, FirstName, LastName, SecondName, Title, DOB, ALTDOB1, ALTDOB2, "
    "ALTDOB3, AddressLine1, AddressLine2, City, Country, POB, WLType, OriginalSource, Remark, "
    "NationalIDInfo, NationalIDNo, " + ", ".join(IDS) + ", Nationality, Citizenship"
)


def _cut(column: str, width: int) -> str:
    return f"substring({column},1,{width})"


def _slots(value: str, name: str, n: int, slot: str = "slot", start: int = 1) -> str:
    return ", ".join(
        f"max({value}) filter (where {slot}={i + start - 1}) {name}{i}" for i in range(1, n + 1)
    )


def _list_row(first: str, last: str, second: str, alias_id: str, alias: str) -> str:
    kept = (
        "ReferenceID, DOB, ALTDOB1, ALTDOB2, ALTDOB3, City, Country, WLType, OriginalSource, Remark, "
        "NationalIDInfo, NationalIDNo, " + ", ".join(IDS) + ", p.EntityGUID, Nationality, POB"
    )
    return f"""{kept},
      case EntityType when 'Individual' then '3' when 'Country' then '1' when 'Organization' then '9'
        when 'Vessel' then '4' else '6' end EntityType,
      {_cut('Gender', 7)} Gender, {first} FirstName, {last} LastName, {second} SecondName,
      {_cut('p.Title', 255)} Title, {_cut('AddressLine1', 200)} AddressLine1,
      {_cut('AddressLine2', 200)} AddressLine2, {_cut('Citizenship', 70)} Citizenship,
      {alias_id} EntityAliasGUID, {alias} Alias, '{VERSION}' VersionID, 'add' Action,
      '{RUN_TS[:10]}' FileName, timestamp '{RUN_TS}' CreationDate,
      cast(null as integer) LastUpdatedBy, cast(null as timestamp) LastUpdatedDate"""


STEPS = {
    "src_new": """select EntityGUID,
        coalesce(string_agg(distinct SourceURI, '; ' order by SourceURI)
                 filter (where SourceURI<>''), '') SourceURI
      from srcitem group by EntityGUID""",
    "address_sized": """select EntityGUID, Address1, Address2, City, ISOStandard,
        coalesce(length(rtrim(Address1)),0)+coalesce(length(rtrim(Address2)),0)
          +coalesce(length(rtrim(City)),0)+coalesce(length(rtrim(ISOStandard)),0) chars
      from address where AddressTypeDesc<>'Place Of Birth'""",
    "address_best": """select EntityGUID, Address1, Address2, City, ISOStandard from address_sized
      where (EntityGUID, chars) in (select EntityGUID, max(chars) from address_sized group by 1)""",
    "address_new": """select b.EntityGUID, b.Address1 AddressLine1, b.Address2 AddressLine2, b.City,
        b.ISOStandard CountryCode, z.City POB, tCountry Country
      from address_best b left join country on tISO=b.ISOStandard
      left join address z on z.EntityGUID=b.EntityGUID and z.AddressTypeDesc='Place Of Birth'""",
    "address_one": """select EntityGUID, Address1, Address2, City, ISOStandard from (
        select *, row_number() over (partition by EntityGUID order by chars desc,
          Address1 nulls last, Address2 nulls last, City nulls last, ISOStandard nulls last) nth
        from address_sized) where nth=1""",
    "citizenship_new": """select distinct a.EntityGUID, a.ISOStandard, tCountry Citizenship
      from assoc a join (select EntityGUID, max(AdministrativeUnitName) unit from assoc
        where AssociationTypeDesc='Citizenship' group by 1) m
        on m.EntityGUID=a.EntityGUID and m.unit=a.AdministrativeUnitName
      left join country on tISO=a.ISOStandard where a.AssociationTypeDesc='Citizenship'""",
    "dob_text": """select distinct EntityGUID, case when trim(BirthMonth)='' and trim(BirthDay)=''
        then BirthYear else BirthYear||'-'||BirthMonth||'-'||BirthDay end dob from dob""",
    "dob_slots": """select EntityGUID, dob, row_number() over (partition by EntityGUID
        order by dob desc nulls last) slot,
        case when length(dob)>7 then try_strptime(dob,'%Y-%m-%d') end alt from dob_text""",
    "dob_new": f"""select EntityGUID, max(dob) filter (where slot=1) DOB,
        {_slots('alt', 'ALTDOB', 3, start=2)} from dob_slots group by 1""",
    "dob_text_year": """select distinct EntityGUID,
        case when trim(coalesce(BirthMonth,''))='' and trim(coalesce(BirthDay,''))='' then BirthYear
        else BirthYear||'-'||coalesce(BirthMonth,'')||'-'||coalesce(BirthDay,'') end dob from dob""",
    "dob_slots_date": """select EntityGUID, dob, row_number() over (partition by EntityGUID
        order by try_strptime(dob,'%Y-%m-%d') desc nulls last, dob desc nulls last) slot,
        case when length(dob)>7 then try_strptime(dob,'%Y-%m-%d') end alt from dob_text_year""",
    "dob_by_date": f"""select EntityGUID, max(dob) filter (where slot=1) DOB,
        {_slots('alt', 'ALTDOB', 3, start=2)} from dob_slots_date group by 1""",
    "national_new": """select EntityGUID,
        left(coalesce(string_agg(distinct IdentificationNumber, '; ' order by IdentificationNumber)
          filter (where IdentificationNumber<>''),''),50) IdentificationNumber,
        left(coalesce(string_agg(distinct IdentificationTypeDesc, '; '
          order by IdentificationTypeDesc),''),85) IdentificationTypeDesc
      from ident where IdentificationTypeDesc like 'National Id%' group by 1""",
    "national_null": """select n.EntityGUID,
        case when c.filled=0 and c.rows=1 then null else n.IdentificationNumber end
          IdentificationNumber, n.IdentificationTypeDesc
      from national_new n join (select EntityGUID, count(*) rows, count(IdentificationNumber) filled
        from ident where IdentificationTypeDesc like 'National Id%' group by 1) c
        on c.EntityGUID=n.EntityGUID""",
    "ident_slots": """select EntityGUID, left(IdentificationTypeDesc,85) kind,
        left(IdentificationNumber,50) num, row_number() over (partition by EntityGUID
          order by left(IdentificationNumber,50) desc nulls last,
          left(IdentificationTypeDesc,85) nulls last) slot
      from ident where EntityGUID not in (select EntityGUID from national_new)""",
    "ident_new": f"""select EntityGUID, {_slots('kind', 'IdOtherInfo', 5)}, {_slots('num', 'IdNo', 5)}
      from ident_slots where slot<=5 group by 1""",
    "remark_new": """select EntityGUID,
        left(coalesce(string_agg(distinct left(Remark,4000), '; ' order by left(Remark,4000))
          filter (where Remark<>''),''),4000) Remark from remark group by 1""",
    "remark_null": """select r.EntityGUID,
        case when c.filled=0 and c.rows=1 then null else r.Remark end Remark
      from remark_new r join (select EntityGUID, count(*) rows, count(Remark) filled from remark
        group by 1) c on c.EntityGUID=r.EntityGUID""",
    "nat": """select EntityGUID, tCountry Nationality from assoc, country
      where AssociationTypeDesc='Nationality' and tISO=ISOStandard""",
    "pep": "select distinct EntityGUID from assoc where AssociationTypeDesc='PEP'",
    "kept_entity": "select * from entity",
    "wide": f"""select e.EntityGUID, e.EntityID ReferenceID, e.EntityTypeDesc EntityType, e.Gender,
        coalesce(e.FirstName,'')||' '||coalesce(e.MiddleName,'') FirstName, e.LastName,
        e.Name SecondName, e.Title, DOB, ALTDOB1, ALTDOB2, ALTDOB3, AddressLine1, AddressLine2, City,
        Country, POB, coalesce(enforcement.SourceName, sanction.SourceName) source, SourceURI OriginalSource, Remark,
        IdentificationTypeDesc NationalIDInfo, IdentificationNumber NationalIDNo,
        {", ".join(IDS)}, Nationality, Citizenship, pep.EntityGUID is not null exposed
      from kept_entity e left join nat using (EntityGUID) left join citizenship_new using (EntityGUID)
      left join dob_new using (EntityGUID) left join address_new using (EntityGUID)
      left join enf enforcement using (EntityGUID) left join san sanction using (EntityGUID)
      left join src_new using (EntityGUID) left join remark_null using (EntityGUID)
      left join national_null using (EntityGUID) left join ident_new using (EntityGUID)
      left join pep using (EntityGUID)""",
    "nonpep_rows": f"""select EntityGUID, {ATTRIBUTES} from (
        select *, left(source,50) WLType from wide where not exposed or source<>'PEP')""",
    "pep_rows": f"select EntityGUID, {ATTRIBUTES} from (select *, 'PEP' WLType from wide where exposed)",
    "consolidated": "select * from nonpep_rows union all select * from pep_rows",
    "consolidated_dedup": "select * from nonpep_rows union select * from pep_rows",
    "base_rows": "select " + _list_row(
        "p.FirstName", _cut("p.LastName", 150), _cut("p.SecondName", 300),
        "cast(null as varchar)", "cast(null as varchar)") + " from consolidated p",
    "alias_rows": "select " + _list_row(
        _cut("coalesce(a.FirstName,'')||' '||coalesce(a.MiddleName,'')", 300),
        _cut("a.LastName", 255), _cut("a.Name", 500), "a.EntityAliasGUID", _cut("a.Name", 500))
      + " from consolidated p join alias a on a.EntityGUID=p.EntityGUID "
        f"and a.AliasTypeDesc not in ({EXCLUDED})",
    "published": "select * from base_rows union all select * from alias_rows",
    "master_rows": f"""select ReferenceID, WLType, FileName, VersionID,
        cast(EntityType as decimal(2,0)) EntityType, cast(null as varchar) Source, OriginalSource,
        Action, Gender, {_cut('LastName', 150)} LastName, FirstName, {_cut('SecondName', 300)} SecondName,
        POB, DOB, ALTDOB1, ALTDOB2, ALTDOB3, Nationality, Citizenship, Alias, Title, AddressLine1,
        AddressLine2, City, {", ".join(IDS)}, NationalIDNo, NationalIDInfo, EntityGUID Basis,
        Remark Remarks, Country, CreationDate, LastUpdatedBy, LastUpdatedDate from published""",
    "name_search": """select upper(FirstName)||' '||upper(LastName) FirstName,
        upper(LastName)||' '||upper(FirstName) LastName, Nationality
      from (select coalesce(FirstName,'') FirstName, coalesce(LastName,'') LastName, Nationality
        from published)""",
    "summary_rows": f"""select * from (
        select 'Total Negative List Records' "Type", count(*) "Count" from published
        union all select 'New Negative List Records', count(*) from published
        union all select 'Updated Negative List Records', 0),
        (select timestamp '{RUN_TS}' RunDate)""",
    "id_facts": """select count(*) n, count(*) distinct_ids, 1 first_id, count(*) last_id
      from published""",
}

_WORD = re.compile(r"\b\w+\b")


def answer(step: str, replace: dict[str, str] | None = None) -> str:
    """One SQL string for a step, on the plain tables.

    ``replace`` exchanges the text of some steps, for variants of a chain.
    """
    steps = {**{v: view_sql(v) for v in VIEWS}, **STEPS, **(replace or {})}
    order: list[str] = []

    def visit(name: str) -> None:
        text = re.sub(r"'[^']*'", "", steps[name])
        # A fixture projects plain tables only; its column words are no steps.
        words = [] if name in VIEWS else _WORD.findall(text)
        for word in words:
            if word in steps and word != name and word not in order:
                visit(word)
        if name not in order:
            order.append(name)

    visit(step)
    # No step may carry the name of a driver table, so every one is quoted as is.
    parts = [f"{name} as ({steps[name]})" for name in order]
    return f"with {', '.join(parts)} select * from {step}"
