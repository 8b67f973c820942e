"""Runs registered queries and their SQL side by side and reports differences."""

from __future__ import annotations

import sys
import time
from collections import Counter

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(folder: str):
    import duckdb

    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return float(f"{value:.9g}") + 0.0
    return value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(spark, connection, folder, query, sql):
    """None if both agree, otherwise a short description."""
    df = query(spark, folder)
    mine = _bag(df.columns, [tuple(r) for r in df.collect()])
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = _bag(names, cursor.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    if mine == theirs:
        return None
    only_mine, only_theirs = mine - theirs, theirs - mine
    return (
        f"rows {sum(mine.values())}/{sum(theirs.values())}, {sum(only_mine.values())} differ; columns {sorted(names)}\n"
        f"   spark  {sorted(only_mine, key=str)[:3]}\n   duckdb {sorted(only_theirs, key=str)[:3]}"
    )


def main(folder: str, names: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from riskspark.session import build_session

    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(folder)
    queries, sql = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in names or list(queries):
        start = time.time()
        try:
            if name in sql:
                problem = difference(spark, connection, folder, queries[name], sql[name])
            else:
                problem = None if queries[name](spark, folder).count() >= 0 else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
