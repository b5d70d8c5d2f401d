"""DataFrame operators of the watchlist."""

from .address import address_rows, best_by_length, birth_places, format_address
from .consolidate import consolidate, entity_row_limit
from .country import map_citizenship, map_nationality, pep_entities
from .merge import merge_national_ids, merge_remarks, merge_sources, merge_text
from .pivot import format_birth_dates, pivot_other_ids, slot_pivot
from .publish import assign_ids, publish, publish_alias, publish_base
from .views import filter_view, master_view, run_summary

__all__ = [
    "address_rows", "assign_ids", "best_by_length", "birth_places", "consolidate",
    "entity_row_limit", "filter_view", "format_address", "format_birth_dates",
    "map_citizenship", "map_nationality", "master_view", "merge_national_ids",
    "merge_remarks", "merge_sources", "merge_text", "pep_entities",
    "pivot_other_ids", "publish", "publish_alias", "publish_base", "run_summary",
    "slot_pivot",
]
