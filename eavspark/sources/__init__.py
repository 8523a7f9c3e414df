"""Fixed-length page files as Spark tables."""
