"""Readers and writers for the raw tables, the weather archives and the keyed store."""
