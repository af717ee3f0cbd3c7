"""Composed plans: the query registry, oracle SQL and the full pipeline."""
