"""Compositions: lazily planned layers, the query catalog, the batch jobs."""
