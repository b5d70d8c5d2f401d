"""Watchlist consolidation as Spark DataFrame operators."""
