"""Run registered queries next to their SQL and compare the rows as multisets: python tests/oracle_compare.py [sf] [names]."""

import datetime
import math
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return str(value)


def multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, function, sql, sf_dir):
    frame = function(spark, sf_dir)
    ours = multiset(frame.columns, [tuple(r) for r in frame.collect()])
    result = con.execute(sql)
    theirs = multiset([d[0] for d in result.description], result.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}", len(ours[1])
    if ours[1] != theirs[1]:
        a, b = set(ours[1]), set(theirs[1])
        example = (sorted(a - b)[:2], sorted(b - a)[:2])
        return f"{len(ours[1])} rows against {len(theirs[1])}; only ours / only SQL: {example}", len(ours[1])
    return "", len(ours[1])


def main():
    from __spark_entry__ import oracle_sql, queries
    from barloom.session import local_session

    sf_dir = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    wanted = sys.argv[2:]
    spark = local_session(8, folder=tempfile.mkdtemp(prefix="barloom-compare-"))
    con, sql = connect(sf_dir), oracle_sql()
    bad = 0
    for name, function in queries().items():
        if wanted and name not in wanted:
            continue
        began = time.time()
        try:
            if name in sql:
                problem, n = compare(spark, con, function, sql[name], sf_dir)
            else:
                problem, n = "", function(spark, sf_dir).count()
        except Exception as error:
            problem, n = f"{type(error).__name__}: {str(error)[:200]}", -1
        bad += bool(problem)
        state = "FAIL" if problem else ("ok" if name in sql else "rows")
        print(f"{state:4} {name:32} {n:7} rows {time.time() - began:6.2f}s {problem}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
