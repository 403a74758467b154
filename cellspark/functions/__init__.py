"""Column-level functions; all are built-in Spark expressions."""
