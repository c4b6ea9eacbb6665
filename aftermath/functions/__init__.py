"""Column-level helpers built from native Spark expressions."""
