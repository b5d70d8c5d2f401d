"""What readers see of the published list."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import encode_entity_type, fit
from ..schemas import KEY


def master_view(watchlist: DataFrame) -> DataFrame:
    """The list in its exchange layout, with a numeric entity type."""
    kind = F.col("EntityType")
    code = F.coalesce(
        kind.try_cast("decimal(2,0)"), encode_entity_type(kind).cast("decimal(2,0)")
    )
    slots = [F.col(c) for i in range(1, 6) for c in (f"IdNo{i}", f"IdOtherInfo{i}")]
    return watchlist.select(
        "ID", "ReferenceID", "WLType", "FileName", "VersionID",
        code.alias("EntityType"),
        F.lit(None).cast("string").alias("Source"),
        "OriginalSource", "Action",
        fit(F.col("Gender"), 7).alias("Gender"),
        fit(F.col("LastName"), 150).alias("LastName"),
        "FirstName",
        fit(F.col("SecondName"), 300).alias("SecondName"),
        "POB", "DOB", "ALTDOB1", "ALTDOB2", "ALTDOB3", "Nationality",
        fit(F.col("Citizenship"), 70).alias("Citizenship"),
        "Alias",
        fit(F.col("Title"), 255).alias("Title"),
        fit(F.col("AddressLine1"), 200).alias("AddressLine1"),
        fit(F.col("AddressLine2"), 200).alias("AddressLine2"),
        "City", *slots, "NationalIDNo", "NationalIDInfo",
        F.col(KEY).alias("Basis"), F.col("Remark").alias("Remarks"), "Country",
        "CreationDate", "LastUpdatedBy", "LastUpdatedDate",
    )


def filter_view(watchlist: DataFrame) -> DataFrame:
    """Both name orders in upper case, for name search."""
    first = F.upper(F.coalesce("FirstName", F.lit("")))
    last = F.upper(F.coalesce("LastName", F.lit("")))
    return watchlist.select(
        "ID",
        F.concat(first, F.lit(" "), last).alias("FirstName"),
        F.concat(last, F.lit(" "), first).alias("LastName"),
        "Nationality",
    )


def run_summary(watchlist: DataFrame, run_ts: str | None = None) -> DataFrame:
    """Three rows on a full reload: all records are new, none is updated."""
    run_ts = run_ts or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    total = F.col("_total")
    lines = F.array(*[
        F.struct(F.lit(kind).alias("Type"), count.cast("long").alias("Count"))
        for kind, count in [
            ("New Negative List Records", total),
            ("Updated Negative List Records", F.lit(0)),
            ("Total Negative List Records", total),
        ]
    ])
    return watchlist.agg(F.count("*").alias("_total")).select(F.inline(lines)).withColumn(
        "RunDate", F.lit(run_ts).cast("timestamp_ntz")
    )
