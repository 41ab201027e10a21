"""Operators of a training-data pipeline: quality, archives, decontamination, packing, deduplication, search."""
