"""Operators for preparing training data: counting, labelling, deduplication, sharding, search."""
