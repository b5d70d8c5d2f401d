"""Reading the delimited feed."""

from .feed import collate, load_audit, quarantined, read_feed, read_tables, stage_feed, staged_audit, staged_tables

__all__ = [
    "collate", "load_audit", "quarantined", "read_feed", "read_tables", "stage_feed", "staged_audit", "staged_tables",
]
