"""Operators of a training-data pipeline: near-duplicates, line dedup, n-gram
joins, quality scoring, sharding, packing, HTML extraction, mixing, quality
rules and licence scans.  Nothing else in the library imports this package."""
