"""Model builds, BI queries, data quality and table upkeep."""
