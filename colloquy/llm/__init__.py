"""Operators of a training-data pipeline: packing, secret scans, extraction, search, sharding, joins, classifiers.

Nothing else in the library imports this subpackage.
"""
