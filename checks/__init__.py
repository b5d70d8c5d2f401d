"""Stand-in feed tables over the driver's data, and DuckDB answers for them."""
