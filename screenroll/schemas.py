"""Column contracts: feed tables, wide profiles and the published list.

Fixed values: table names, column names, order and widths are part of the
data contract and are stated as they are.
"""

from __future__ import annotations

from pyspark.sql import types as T

KEY = "EntityGUID"

# A width in characters, None for unlimited text, or "ts" for a timestamp.
FEED = {
    "AssociatedEntity": {
        "EntityGUID": 50, "AssociatedEntityGUID": 50, "SubCategoryLabel": 100,
        "LastUpdated": "ts", "SourceName": 500,
    },
    "ConsolidatedSanction": {
        "ConsolidatedSanctionGUID": 50, "EntityGUID": 50, "LastUpdated": "ts",
    },
    "Entity": {
        "EntityGUID": 50, "EntityTypeDesc": 50, "Gender": 50, "Name": 500,
        "FirstName": 200, "MiddleName": 200, "LastName": 500, "Prefix": 100,
        "Suffix": 50, "Title": 500, "IsDeceased": 10, "DeceasedYear": 10,
        "DeceasedMonth": 10, "DeceasedDay": 10, "IsRelatedEntity": 10,
        "EntityID": 50, "LookupID": 50, "LastUpdated": "ts", "AssociatedPhoto": 10,
    },
    "EntityAddress": {
        "EntityGUID": 50, "EntityAddressGUID": 50, "AddressTypeDesc": 100,
        "Address1": 500, "Address2": 500, "City": 200, "StateProvinceRegion": 200,
        "PostalCode": 50, "Country": 200, "ISOStandard": 50, "LastUpdated": "ts",
    },
    "EntityAdverseMedia": {
        "EntityGUID": 50, "EntityAdverseMediaGUID": 50, "AdverseMediaDesc": 50,
        "LastUpdated": "ts",
    },
    "EntityAdverseMediaSubCategory": {
        "EntityAdverseMediaGUID": 50, "EntityAdverseMediaSubCategoryGUID": 50,
        "SubCategoryLabel": 100, "LastUpdated": "ts",
    },
    "EntityAlias": {
        "EntityGUID": 50, "EntityAliasGUID": 50, "AliasTypeDesc": 100,
        "EnglishDescription": 100, "Name": 500, "FirstName": 200, "MiddleName": 200,
        "LastName": 500, "Prefix": 100, "Suffix": 50, "LastUpdated": "ts",
    },
    "EntityCountryAssociation": {
        "EntityGUID": 50, "EntityCountryAssociationGUID": 50,
        "AssociationTypeDesc": 100, "AdministrativeUnitName": 200, "ISOStandard": 50,
        "OwnershipPercentageCalc": 50, "LastUpdated": "ts",
    },
    "EntityDeletes": {"EntityGUID": 50, "DateDeleted": "ts"},
    "EntityDOB": {
        "EntityGUID": 50, "EntityDOBGUID": 50, "BirthYear": 10, "BirthMonth": 10,
        "BirthDay": 10, "LastUpdated": "ts",
    },
    "EntityEnforcement": {
        "EntityGUID": 50, "EntityEnforcementGUID": 50, "EnforcementDesc": 50,
        "SourceName": 500, "SourceNameAbbrev": 50, "AdministrativeUnitName": 200,
        "ISOStandard": 50, "LastUpdated": "ts",
    },
    "EntityEnforcementSubCategory": {
        "EntityEnforcementGUID": 50, "EntityEnforcementSubCategoryGUID": 50,
        "SubCategoryLabel": 100, "LastUpdated": "ts",
    },
    "EntityIdentification": {
        "EntityGUID": 50, "EntityIdentificationGUID": 50,
        "AdministrativeUnitName": 200, "ISOStandard": 50,
        "IdentificationIssuer": 500, "IdentificationTypeDesc": 200,
        "IdentificationNumber": 200, "IssueYear": 10, "IssueMonth": 10,
        "IssueDay": 10, "ExpirationYear": 10, "ExpirationMonth": 10,
        "ExpirationDay": 10, "LastUpdated": "ts",
    },
    "EntityRemark": {
        "EntityGUID": 50, "EntityRemarkGUID": 50, "Remark": None, "LastUpdated": "ts",
    },
    "EntitySanction": {
        "EntityGUID": 50, "EntitySanctionGUID": 50, "SubCategoryLabel": 100,
        "ConsolidatedSanctionGUID": 50, "SourceName": 500, "SourceNameAbbrev": 50,
        "AdministrativeUnitName": 200, "ISOStandard": 50, "LastUpdated": "ts",
    },
    "EntitySourceItem": {
        "EntityGUID": 50, "EntitySourceItemGUID": 50, "SourceURI": None,
        "LastUpdated": "ts",
    },
    # The country lookup is an input like any other table.
    "Country": {"tISO": 10, "tCountry": 100},
}

ID_SLOTS = [c for i in range(1, 6) for c in (f"IdOtherInfo{i}", f"IdNo{i}")]

PROFILE_COLUMNS = [
    "EntityGUID", "ReferenceID", "EntityType", "Gender", "FirstName", "LastName",
    "SecondName", "Title", "DOB", "ALTDOB1", "ALTDOB2", "ALTDOB3", "AddressLine1",
    "AddressLine2", "City", "Country", "POB", "WLType", "OriginalSource", "Remark",
    "NationalIDInfo", "NationalIDNo", *ID_SLOTS, "Nationality", "Citizenship",
]

WATCHLIST_COLUMNS = [
    "ID", "ReferenceID", "EntityType", "Gender", "FirstName", "LastName",
    "SecondName", "Title", "DOB", "ALTDOB1", "ALTDOB2", "ALTDOB3", "AddressLine1",
    "AddressLine2", "City", "Country", "WLType", "OriginalSource", "Remark",
    "NationalIDInfo", "NationalIDNo", *ID_SLOTS, "EntityGUID", "EntityAliasGUID",
    "Nationality", "Citizenship", "POB", "Alias", "VersionID", "Action", "FileName",
    "CreationDate", "LastUpdatedBy", "LastUpdatedDate",
]

# Alias types that never become list rows.
EXCLUDED_ALIAS_TYPES = [
    "Acronym",
    "Call Sign",
    "Chinese Commercial Code (CCC)",
    "Native Script For Alias",
    "Native Script For Entity",
]

# Entity type label -> published code; anything else is "6".
ENTITY_TYPE_CODES = {"Individual": "3", "Country": "1", "Organization": "9", "Vessel": "4"}
OTHER_ENTITY_TYPE = "6"

NATIONAL_ID_PREFIX = "National Id"
BIRTH_PLACE = "Place Of Birth"


def feed_schema(table: str) -> T.StructType:
    """Spark schema of one feed table; every column is nullable.

    Feed timestamps carry no zone, so they are TIMESTAMP_NTZ and do not move
    with the session time zone.
    """
    return T.StructType([
        T.StructField(name, T.TimestampNTZType() if width == "ts" else T.StringType())
        for name, width in FEED[table].items()
    ])
