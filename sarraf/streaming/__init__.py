"""Structured Streaming: landing, incremental dedup, change feeds, hourly totals."""
