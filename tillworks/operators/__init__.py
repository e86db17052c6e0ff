"""Reusable DataFrame operators: ordering, loading, checks, splits, clustering."""
