"""Structured Streaming ingest of record envelopes."""
