"""Column expressions shared by the operators; all built-in, no UDF."""

from .codes import encode_entity_type
from .dates import partial_date, safe_date
from .text import fit, full_name, visible_length

__all__ = [
    "encode_entity_type", "fit", "full_name", "partial_date", "safe_date",
    "visible_length",
]
