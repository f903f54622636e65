"""Compare registered queries with their SQL on the same files.

``python -m tests.oracle_check [folder] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime as dt
import sys
import time
from decimal import Decimal

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def _table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(lines, key=repr)


def compare(spark, con, folder, run, sql) -> str:
    """Empty text if equal, else the first difference."""
    frame = run(spark, folder)
    mine_columns, mine = _table(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    their_columns, theirs = _table(names, cursor.fetchall())
    if mine_columns != their_columns:
        return f"columns {mine_columns} != {their_columns}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)}"
    for a, b in zip(mine, theirs):
        if repr(a) != repr(b) or any(isinstance(v, Decimal) for v in b):
            bad = [(c, x, y) for c, x, y in zip(mine_columns, a, b) if repr(x) != repr(y)]
            return f"first difference: {bad[:4] or a}"
    return ""


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from granary import session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = session.create("oracle check", "local[8]", 8, {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    sql, failed = oracle_sql(), 0
    for name, run in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in sql:
                problem = compare(spark, con, folder, run, sql[name])
            else:
                problem = "" if run(spark, folder).collect() else "no rows"
        except Exception as error:  # a broken query must not hide the others
            problem = f"{type(error).__name__}: {str(error)[:1200]}"
        failed += bool(problem)
        mark = "BAD " if problem else ("ok  " if name in sql else "rows")
        print(f"{mark} {name} {time.time() - start:.1f}s {problem}", flush=True)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
