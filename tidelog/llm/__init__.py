"""Training-data operators: extraction, scoring, deduplication, mixing and tokenising.

Nothing else in the library imports this subpackage.
"""
