"""Training-data operators: formatting, sharding, quality, dedup, packing.

Nothing else in the library imports this subpackage.
"""
