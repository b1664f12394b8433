"""Unbounded forms.

Operators that are plain aggregates work on streams as they are; this package has
the runs, and the forms that need state or per-batch work.
"""
