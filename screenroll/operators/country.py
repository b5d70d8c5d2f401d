"""Country links of an entity: citizenship, nationality, political exposure."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fit
from ..schemas import KEY


def _of_type(assoc: DataFrame, kind: str) -> DataFrame:
    return assoc.where(F.col(KEY).isNotNull() & (F.col("AssociationTypeDesc") == kind))


def map_citizenship(assoc: DataFrame, country: DataFrame) -> DataFrame:
    """Distinct citizenship codes with the last unit name of the entity, and their country.

    Equal links are made distinct first, by hashing alone; the ranking leaves the rows where the
    final distinct needs them.
    """
    links = (
        _of_type(assoc, "Citizenship")
        .select(KEY, "ISOStandard", fit(F.col("AdministrativeUnitName"), 200).alias("_unit"))
        .distinct()
    )
    order = Window.partitionBy(KEY).orderBy(F.col("_unit").desc_nulls_last())
    ranked = links.withColumn("_nth", F.rank().over(order)).where(F.col("_nth") == 1)
    top = ranked.select(KEY, "ISOStandard").distinct()
    return top.join(country, top["ISOStandard"] == country["tISO"], "left").select(
        KEY, "ISOStandard", fit(F.col("tCountry"), 100).alias("Citizenship")
    )


def map_nationality(assoc: DataFrame, country: DataFrame) -> DataFrame:
    """Country name of each nationality; codes missing from the lookup are dropped."""
    links = _of_type(assoc, "Nationality")
    return links.join(country, links["ISOStandard"] == country["tISO"]).select(
        KEY, F.col("tCountry").alias("Nationality")
    )


def pep_entities(assoc: DataFrame) -> DataFrame:
    """Ids of the politically exposed entities, each once."""
    return _of_type(assoc, "PEP").select(KEY).distinct()
