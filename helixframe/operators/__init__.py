"""Reusable DataFrame operators: lookups, hierarchy, merges, deletions, checks."""
