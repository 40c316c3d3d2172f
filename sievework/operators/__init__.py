"""Relational operators: gates, cleaning, dedup, routing, retrieval, targets, analytics, generation rounds."""
