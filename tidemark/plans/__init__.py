"""Queries over the driver's tables."""

from tidemark.plans import catalogue, collection, pipelines, reading  # noqa: F401  (each registers its queries)
