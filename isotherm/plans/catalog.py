"""All registered queries."""

from isotherm.plans import catalog_cluster, catalog_grid, catalog_tables  # noqa: F401
from isotherm.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
