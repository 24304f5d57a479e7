"""Structured Streaming forms of cleaning, dedup, upsert and trend."""
