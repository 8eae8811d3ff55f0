"""Annotation tables derived from the given test tables, and their checks."""
