"""helixframe: genome-annotation analytics as Spark DataFrame jobs."""

from helixframe.tables import Tables

__all__ = ["Tables"]
