"""Training-data operators (deduplication, quality, mixing, packing, ...).

Nothing else in the library imports this subpackage.
"""
