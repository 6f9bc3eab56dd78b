"""Operators of a training-data pipeline.

Each module holds one operator with an interface of its own; ``queries`` derives
the registered queries from them.  Nothing else in the library imports this.
"""
