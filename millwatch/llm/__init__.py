"""Operators for preparing training text: fingerprints, filters, joins, mixing and encoding."""
