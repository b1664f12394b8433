"""Operators of a training-data pipeline, their queries and their SQL oracles.

Nothing else in the library imports this package.  Each module holds one operator with
its own general interface; ``queries`` binds them to the benchmark tables.
"""
