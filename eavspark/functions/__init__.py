"""Column expressions for the binary field types."""
