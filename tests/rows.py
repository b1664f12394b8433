"""Rows in a form that tests can compare."""


def tuples(df, *columns):
    return sorted(tuple(row) for row in df.select(*columns).collect())
