"""Operators of a training-data pipeline: extraction, deduplication, filtering,
mixing and tokenising.  Nothing outside this package imports it."""
