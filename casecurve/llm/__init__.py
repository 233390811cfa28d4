"""Operators of a training-data pipeline: fingerprints, tokens, quality, dedup, packing, archives, shards."""
