"""Operators for training-data pipelines: decontamination, deduplication,
search, extraction, scoring and token output. Nothing outside this package
imports it."""
