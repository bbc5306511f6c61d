"""Run the queries against their SQL and report what differs.

    python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return value


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def compare(spark, connection, made, sql: str, sf_dir: str) -> str:
    """Empty if the rows agree, else what differs."""
    df = made(spark, sf_dir)
    found = _rows(df.columns, [tuple(row) for row in df.collect()])
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    wanted = _rows(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(found) != len(wanted):
        return f"{len(found)} rows != {len(wanted)}"
    for a, b in zip(found, wanted, strict=True):
        if a != b:
            return f"{str(a)[:300]} != {str(b)[:300]}"
        if [type(x) for x in a] != [type(x) for x in b]:
            return f"types of {str(a)[:300]} != {str(b)[:300]}"
    return ""


def main() -> int:
    from conftest import local_session

    from __spark_entry__ import oracle_sql, queries

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, connection = local_session(), connect(sf_dir)
    oracles, bad = oracle_sql(), 0
    wanted = sys.argv[2:] or list(queries())
    for name in wanted:
        start = time.time()
        try:
            if name in oracles:
                problem = compare(spark, connection, queries()[name], oracles[name], sf_dir)
            else:
                n = len(queries()[name](spark, sf_dir).collect())
                problem = "" if n else "no rows"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        kind = "SQL " if name in oracles else "rows"
        print(f"{kind} {time.time() - start:6.1f}s {name}: {problem or 'ok'}", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
