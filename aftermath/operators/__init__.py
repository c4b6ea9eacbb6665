"""Relational steps: cleaning, matching, aggregation, features, merging, reporting."""
