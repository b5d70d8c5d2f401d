"""Wide profiles: every entity joined with all its attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fit, full_name
from ..plans.skew import DEFAULT_POLICY, SkewPolicy, heavy_keys, split_counts
from ..plans.star import HUB, Satellite, star_join
from ..schemas import BIRTH_PLACE, KEY, PROFILE_COLUMNS
from .address import address_rows, birth_places
from .country import map_citizenship, map_nationality, pep_entities
from .merge import merge_national_ids, merge_remarks, merge_sources
from .pivot import format_birth_dates, pivot_other_ids

PEP = "PEP"

# Columns of the staging tables that can repeat without bound within an entity
# and reach the star join row by row.
_MANY = ("nationality", "enforcement", "sanction", "address", "birth_place")


def entity_row_limit(entity: DataFrame, n: int) -> DataFrame:
    """Entities with the first ``n`` ids in ascending order, for trial runs."""
    first = entity.select(KEY).orderBy(F.col(KEY).asc_nulls_first()).limit(n)
    return entity.join(first, KEY, "left_semi")


def consolidate(
    tables: dict[str, DataFrame],
    row_limit: int | None = None,
    dedup: bool = False,
    policy: SkewPolicy = DEFAULT_POLICY,
    **options,
) -> DataFrame:
    """Profiles of all entities, from the staging tables and the country lookup.

    An entity gives one row for each combination of its nationalities,
    citizenships, best addresses, birth places, enforcements and sanctions (a
    bag, duplicates included). A politically exposed entity gives the row once
    as ``PEP`` and once more under its own source if that is another one.
    ``dedup`` leaves each row once. ``options`` are passed to the field
    operators: ``ties``, ``overlong``, ``order``, ``null_parts``,
    ``null_if_single``.
    """
    if not dedup:
        rows = joined_attributes(tables, row_limit, False, policy, anonymous=False, **options)
        profiles = with_list_type(rows).select(*PROFILE_COLUMNS)
        return profiles.unionByName(nameless_profiles(tables, row_limit, profiles))
    profiles, anonymous = distinct_profiles(tables, row_limit, policy, **options)
    return profiles.unionByName(anonymous)


def nameless_profiles(tables: dict[str, DataFrame], row_limit: int | None, profiles: DataFrame) -> DataFrame:
    """Profiles of the entities without an id, which match nothing, in the columns of ``profiles``."""
    others = _entities(tables["Entity"], row_limit, False)
    types = {f.name: f.dataType for f in profiles.schema}
    empty = [F.lit(None).cast(types[c]).alias(c) for c in PROFILE_COLUMNS if c not in others.columns]
    return others.select("*", *empty).select(*PROFILE_COLUMNS)


def distinct_profiles(
    tables: dict[str, DataFrame],
    row_limit: int | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """Each profile once: those of entities with an id, and the others.

    Joined rows are already partitioned by entity, so they need no further
    shuffle; the rows without an id have their own, small one.
    """
    joined = joined_attributes(tables, row_limit, True, policy, anonymous=False, **options)
    profiles = with_list_type(joined).select(*PROFILE_COLUMNS).distinct()
    return profiles, nameless_profiles(tables, row_limit, profiles).distinct()


def many_inputs(tables: dict[str, DataFrame], row_limit: int | None = None) -> dict[str, DataFrame]:
    """The inputs of the star join that can repeat within an entity, as they are stored."""
    address, assoc = tables["EntityAddress"], tables["EntityCountryAssociation"]
    entity = tables["Entity"] if row_limit is None else entity_row_limit(tables["Entity"], row_limit)
    return {
        HUB: entity,
        "nationality": assoc.where(F.col("AssociationTypeDesc") == "Nationality"),
        "enforcement": tables["EntityEnforcement"],
        "sanction": tables["EntitySanction"],
        "address": address.where(F.col("AddressTypeDesc") != BIRTH_PLACE),
        "birth_place": address.where(F.col("AddressTypeDesc") == BIRTH_PLACE),
    }


def with_list_type(rows: DataFrame) -> DataFrame:
    """Add ``WLType``: one row for the source of an entity, one for its exposure.

    Both kinds of row come from one pass over the joined attributes.
    """
    source, exposed = F.col("_source"), F.col("_exposed").isNotNull()
    listed = ~exposed | F.coalesce(source != PEP, F.lit(False))
    types = F.array_compact(
        F.array(
            F.when(listed, F.struct(fit(source, 50).cast("string").alias("WLType"))),
            F.when(exposed, F.struct(F.lit(PEP).alias("WLType"))),
        )
    )
    return rows.withColumn("_type", F.explode(types)).withColumn("WLType", F.col("_type.WLType"))


def joined_attributes(
    tables: dict[str, DataFrame],
    row_limit: int | None = None,
    dedup: bool = False,
    policy: SkewPolicy = DEFAULT_POLICY,
    last: Satellite | None = None,
    anonymous: bool = True,
    ties: str = "all",
    overlong: str = "error",
    order: str = "text",
    null_parts: str = "null",
    null_if_single: bool = True,
) -> DataFrame:
    """The star join behind the profiles, before the list type is known.

    ``last`` is one more satellite, joined after all others. Satellites with
    one row per entity come first, so that rows multiply late; the long texts
    are joined just before ``last``, as every later join copies them. Heavy keys are
    counted once, on the key columns of the inputs; what they join is counted
    again only for those. Entities without an id match nothing; they bypass
    the joins, or are left out without ``anonymous``.
    """
    hub = _entities(tables["Entity"], row_limit, True)
    address, assoc = tables["EntityAddress"], tables["EntityCountryAssociation"]
    country, ident, remark = tables["Country"], tables["EntityIdentification"], tables["EntityRemark"]

    inputs = many_inputs(tables, row_limit)
    if last:
        inputs[last.name] = last.rows if last.source is None else last.source
    heavy = heavy_keys({**inputs, "remark": remark}, policy, joined=list(inputs))

    satellites = [
        Satellite("exposed", pep_entities(assoc).withColumn("_exposed", F.lit(True))),
        Satellite("birth_dates", format_birth_dates(tables["EntityDOB"], order, null_parts)),
        Satellite(
            "national_ids",
            merge_national_ids(ident, null_if_single).withColumnsRenamed(
                {"IdentificationTypeDesc": "NationalIDInfo", "IdentificationNumber": "NationalIDNo"}
            ),
        ),
        Satellite("other_ids", pivot_other_ids(ident)),
        Satellite("citizenship", map_citizenship(assoc, country).select(KEY, "Citizenship")),
        Satellite("nationality", map_nationality(assoc, country)),
        Satellite("enforcement", _source(tables["EntityEnforcement"], "_enforced")),
        Satellite("sanction", _source(tables["EntitySanction"], "_sanctioned")),
        Satellite(
            "address",
            address_rows(address, country, ties, overlong, heavy.keys("address"))
            .drop("CountryCode"),
        ),
        Satellite("birth_place", birth_places(address, overlong), only_with="HasAddress"),
        Satellite("remarks", merge_remarks(remark, null_if_single, heavy, policy)),
        Satellite(
            "sources",
            merge_sources(tables["EntitySourceItem"])
            .withColumnRenamed("SourceURI", "OriginalSource"),
        ),
    ]
    if last:
        satellites.append(last)
    if dedup:
        satellites = [
            Satellite(s.name, s.rows.distinct(), s.only_with) if s.name in _MANY else s
            for s in satellites
        ]

    rows = {HUB: hub, **{s.name: s.rows for s in satellites}}
    splits = split_counts({name: rows[name] for name in inputs}, policy, heavy=heavy)
    joined = star_join(hub, satellites, splits)
    if anonymous:
        joined = joined.unionByName(
            _entities(tables["Entity"], row_limit, False), allowMissingColumns=True
        )
    return joined.withColumn("_source", F.coalesce("_enforced", "_sanctioned"))


def _entities(entity: DataFrame, row_limit: int | None, with_id: bool) -> DataFrame:
    """Columns an entity brings to its profile, for entities with or without an id."""
    if row_limit is not None:
        entity = entity_row_limit(entity, row_limit)
    return entity.where(F.col(KEY).isNotNull() if with_id else F.col(KEY).isNull()).select(
        KEY,
        fit(F.col("EntityID"), 50).alias("ReferenceID"),
        fit(F.col("EntityTypeDesc"), 50).alias("EntityType"),
        fit(F.col("Gender"), 50).alias("Gender"),
        fit(full_name(F.col("FirstName"), F.col("MiddleName")), 4000).alias("FirstName"),
        fit(F.col("LastName"), 250).alias("LastName"),
        fit(F.col("Name"), 500).alias("SecondName"),
        fit(F.col("Title"), 250).alias("Title"),
    )


def _source(table: DataFrame, name: str) -> DataFrame:
    return table.where(F.col(KEY).isNotNull()).select(KEY, F.col("SourceName").alias(name))
