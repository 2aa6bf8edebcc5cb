"""Operators of a training-data pipeline: fingerprints, language, deduplication, mixing, packing, audits."""
