"""Run registered queries beside their SQL and compare names, row counts and values.

As a script: ``python tests/compare.py FOLDER [name ...]``.
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else f"{value + 0.0:.9g}"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, int):
        return f"{float(value):.9g}"
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return "NULL" if value is None else str(value)


def normal(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def difference(df, connection, sql: str) -> str | None:
    """None when equal, else a short description."""
    mine = normal(df.columns, [tuple(r) for r in df.collect()])
    result = connection.execute(sql)
    theirs = normal([d[0] for d in result.description], result.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} != {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"rows {len(mine[1])} != {len(theirs[1])}"
    if mine[1] != theirs[1]:
        pairs = [(a, b) for a, b in zip(mine[1], theirs[1]) if a != b]
        return f"{len(pairs)} rows differ in {mine[0]}: {pairs[0]}"
    return None


def main(folder: str, names: list[str]) -> int:
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    import __spark_entry__ as entry
    from daystrata.session import local_session

    spark, connection = local_session(), connect(folder)
    queries, oracle = entry.queries(), entry.oracle_sql()
    unknown = set(oracle) - set(queries)
    bad = [f"{u}: oracle without query" for u in unknown]
    for name in names or queries:
        start = time.time()
        try:
            if name in oracle:
                problem = difference(queries[name](spark, folder), connection, oracle[name])
            else:
                problem, rows = None, queries[name](spark, folder).collect()
                name += f" [{len(rows)} rows, no oracle] {rows[:1]}"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'FAIL' if problem else 'ok':4} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
        if problem:
            bad.append(name)
    print(f"{len(bad)} problems: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1], sys.argv[2:]))
