"""Training-data operators: scoring, decontamination, deduplication, sharding and encoding.

Nothing outside this subpackage imports it.
"""
