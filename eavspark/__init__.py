"""Entity-attribute-value analytics on PySpark."""

from eavspark.schemas import KEYS, SCHEMAS, VALUE_TABLES
from eavspark.store import Store

__all__ = ["KEYS", "SCHEMAS", "VALUE_TABLES", "Store"]
