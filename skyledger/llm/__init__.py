"""Operators of a training-data pipeline: tokenising, packing, filtering, searching and deduplicating text at scale.

Nothing outside this subpackage imports it.
"""
