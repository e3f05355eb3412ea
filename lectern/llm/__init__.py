"""Operators of a training-data pipeline: mixing, sharding, token counts, decontamination, secret scans,
substring and near-duplicate removal, pseudonyms, URL filters and quality rules."""
