"""All registered queries."""

from verification import (  # noqa: F401
    association_queries, change_queries, export_queries, import_queries, ontology_queries, report_queries,
    store_queries,
)
from verification.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
