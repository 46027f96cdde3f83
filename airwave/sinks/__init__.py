"""Sinks: raw and enriched tables, summary files, the fact table."""
