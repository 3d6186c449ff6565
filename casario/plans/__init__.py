"""Pipelines: warehouse layers, reports, page extraction."""
