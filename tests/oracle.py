"""Runs registered queries and their SQL twins side by side.

    python -m tests.oracle [sf_dir] [name ...]
"""

from __future__ import annotations

import decimal
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def normal(value):
    if isinstance(value, decimal.Decimal):
        return ("dec", value.normalize())
    return (type(value).__name__, value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        (tuple(normal(r[i]) for i in order) for r in rows),
        key=lambda r: tuple((v is None, str(v)) for v in r),
    )


SQL_TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN"}


def types_differ(con, spark_df, sql: str) -> str | None:
    got = {f.name: SQL_TYPES.get(f.dataType.simpleString()) for f in spark_df.schema}
    want = {r[0]: r[1] for r in con.execute("DESCRIBE " + sql).fetchall()}
    return None if got == want else f"types {got} != {want}"


def mismatch(con, spark_df, sql: str) -> str | None:
    if problem := types_differ(con, spark_df, sql):
        return problem
    got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    if got != want:
        only_got = sorted(set(got) - set(want), key=str)[:2]
        only_want = sorted(set(want) - set(got), key=str)[:2]
        return f"{len(got)} rows against {len(want)}; only Spark {only_got}; only SQL {only_want}"
    return None if got else "empty result"


def main() -> int:
    sys.path.insert(0, ".")
    from twinledger.queries import load
    from twinledger.session import local_session

    args = sys.argv[1:]
    sf = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracles = load()
    con, bad = duck(sf), 0
    for name in args or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf)
            problem = mismatch(con, df, oracles[name]) if name in oracles else None
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok':5}{name:34}{time.time() - start:6.2f}s {problem or ''}",
              flush=True)
    print(f"{bad} problem(s) in {len(args or queries)} queries")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
