"""Operators of a training-data pipeline: mixing, extraction, joins, scans, search, packing."""
