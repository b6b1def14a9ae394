"""Composite plans: star-schema build and load, analytic queries, registry."""
