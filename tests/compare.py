"""Run a registered query and its oracle side by side.

    python tests/compare.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def _plain(value):
    """One spelling per value; whole floats and integers stay different."""
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return ("f", repr(value))
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark, connection, sf_dir: str, build, sql: str) -> tuple[int, str]:
    """Number of result rows, and a description of what differs ("" if nothing)."""
    df = build(spark, sf_dir)
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(df.columns):
        return ours.total(), f"columns {sorted(df.columns)} against {sorted(names)}"
    theirs = _rows(names, cursor.fetchall())
    missing, extra = theirs - ours, ours - theirs
    if not missing and not extra:
        return ours.total(), ""
    shown = f"missing {list(missing)[:2]} extra {list(extra)[:2]}"
    return ours.total(), f"{missing.total()} missing, {extra.total()} extra: {shown}"


def main() -> None:
    from millrace import catalog
    from millrace.session import build_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session(
        "compare",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(sf_dir)
    oracles, bad = catalog.oracle_sql(), []
    for name, build in catalog.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            rows, problem = differences(spark, connection, sf_dir, build, oracles[name])
        except Exception as error:  # reported below, with the others
            rows, problem = 0, f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:32s} {rows:8d} rows {time.time() - started:6.1f} s  {problem or 'ok'}", flush=True)
        if problem:
            bad.append(name)
    print("different:", bad or "none")
    spark.stop()


if __name__ == "__main__":
    main()
