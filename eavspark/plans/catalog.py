"""All registered queries."""

from __future__ import annotations

from eavspark.plans import (  # noqa: F401 - register on import
    catalog_grid,
    catalog_kinds,
    catalog_meta,
    catalog_pages,
    catalog_sync,
    catalog_system,
)
from eavspark.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
