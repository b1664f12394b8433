"""The operators bound to the benchmark tables, each beside its SQL oracle."""

from millrace.catalog import (  # noqa: F401  (importing registers the queries)
    accounts,
    basics,
    joins,
    sales,
    sources,
    streams,
    tracking,
    traffic,
    words,
)
from millrace.catalog import chunked  # noqa: F401  (after the queries it repeats)
from millrace.catalog.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
