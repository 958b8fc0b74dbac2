"""Composed plans: the end-to-end pipeline, the registered queries and their
oracle SQL, the health record."""
