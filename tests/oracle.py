"""Runs registered queries in Spark and their SQL twins in DuckDB and compares all rows exactly.

    python -m tests.oracle /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os
import sys
import time

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).split(".")[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(v):
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, (list, tuple)):
        return [_plain(x) for x in v]
    if isinstance(v, float):
        return repr(v)
    return repr(v) if isinstance(v, bool) else v


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr([_plain(r[i]) for i in order]) for r in rows)


SAME = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
        "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP", "boolean": "BOOLEAN", "array<string>": "VARCHAR[]"}


def compare(spark_df, con, sql):
    rows = [tuple(r) for r in spark_df.collect()]
    rel = con.execute(sql)
    cols = [d[0] for d in rel.description]
    other = rel.fetchall()
    types = {c: str(t) for c, t in zip(cols, con.sql(sql).types)}
    a_cols, a = canonical(spark_df.columns, rows)
    b_cols, b = canonical(cols, other)
    problems = []
    if a_cols != b_cols:
        problems.append(f"columns {a_cols} vs {b_cols}")
    elif a != b:
        left, right = sorted(set(a) - set(b)), sorted(set(b) - set(a))
        problems.append(f"rows {len(a)} vs {len(b)}; only spark {left[:3]}; only sql {right[:3]}")
    for c, t in spark_df.dtypes:
        want = SAME.get(t)
        if want and types.get(c) != want:
            problems.append(f"type of {c}: {t} vs {types.get(c)}")
    return len(a), problems


def main():
    sf_dir, names = sys.argv[1], sys.argv[2:]
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from tallyforge.session import local_session

    spark, con = local_session(), connect(sf_dir)
    queries, sql = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            if name in sql:
                n, problems = compare(queries[name](spark, sf_dir), con, sql[name])
            else:
                n, problems = queries[name](spark, sf_dir).count(), []
        except Exception as e:  # noqa: BLE001
            n, problems = -1, [f"{type(e).__name__}: {str(e)[:700]}"]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name:34s} {n:7d} rows {time.time() - start:6.2f}s "
              f"{'' if name in sql else '(no sql) '}{'; '.join(problems)}", flush=True)
    print(f"{bad} failing")


if __name__ == "__main__":
    main()
