"""Operators for training-data pipelines: token output, deduplication, quality, licences, packing and language models."""
