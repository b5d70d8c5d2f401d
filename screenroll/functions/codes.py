"""Code maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import ENTITY_TYPE_CODES, OTHER_ENTITY_TYPE


def encode_entity_type(label: Column) -> Column:
    """Published code of an entity type label."""
    code = None
    for name, value in ENTITY_TYPE_CODES.items():
        code = (F if code is None else code).when(label == name, value)
    return code.otherwise(OTHER_ENTITY_TYPE)
