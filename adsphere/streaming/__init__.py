"""Streaming drivers for the daily jobs (file stream → running aggregates)."""
