"""Training-data operators: extraction, filtering, deduplication, packing.

Nothing else in the library imports this subpackage.  ``queries`` holds the
registered queries and their SQL.
"""
