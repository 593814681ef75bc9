"""Sinks: partitioned and bucketed tables, upserts, control tables."""
