"""Bindings of the operators to the test tables, each with equivalent SQL."""

from queries import clean, explore, incremental, ingest, match, model, table_features

MODULES = (clean, match, table_features, incremental, ingest, explore, model)
