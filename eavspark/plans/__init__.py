"""Derived tables and the registered queries, composed from the operators."""
