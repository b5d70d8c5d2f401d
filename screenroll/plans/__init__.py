"""Query shapes shared by the operators: skew handling, the star join, full runs."""
