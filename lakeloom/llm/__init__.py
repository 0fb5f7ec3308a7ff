"""Operators of a training-data pipeline: extraction, scoring, deduplication, decontamination, mixing."""
