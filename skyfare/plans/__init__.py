"""Composed plans: the registered query catalog, oracle SQL and pipelines."""
