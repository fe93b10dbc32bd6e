"""Training-data operators: filtering, deduplication, mixing, tokens and packing.

Nothing else in the library imports this subpackage.
"""
