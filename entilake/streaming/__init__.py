"""Ingest of daily increments as a stream."""
