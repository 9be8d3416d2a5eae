"""Training-data operators for large text corpora.

Each module holds one operator with its own interface; ``queries`` applies
them to the given tables.  Nothing outside this package imports it.
"""
