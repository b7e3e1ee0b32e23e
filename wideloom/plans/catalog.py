"""All named queries."""

from wideloom.plans import catalog_checks, catalog_cluster, catalog_graph, catalog_matrix, catalog_profile  # noqa: F401
from wideloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
