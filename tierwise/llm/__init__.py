"""Training-data operators: text cleaning, deduplication, scoring and packing.

Nothing else in the library imports this subpackage; it may import the general
helpers.  :mod:`tierwise.llm.queries` holds the driver queries and their SQL.
"""
