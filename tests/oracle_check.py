"""Run queries against DuckDB: python tests/oracle_check.py [sf_dir] [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def oracle_connection(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _kind(value):
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "bool"
    return type(value).__name__


def normal(rows, columns):
    """Rows with columns by name, sorted; floats to 9 significant digits for the sort and compare."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else float(f"{v:.12g}") + 0.0
        return v

    fixed = [tuple(cell(r[i]) for i in order) for r in rows]
    return sorted(fixed, key=lambda r: [(x is None, str(type(x)), x if x is not None else 0) for x in r])


def compare(spark_df, relation_rows, relation_columns):
    """Empty text when equal, else what differs."""
    if sorted(spark_df.columns) != sorted(relation_columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(relation_columns)}"
    got = normal([tuple(r) for r in spark_df.collect()], spark_df.columns)
    want = normal(relation_rows, relation_columns)
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    for g, w in zip(got, want):
        if g != w or [_kind(x) for x in g] != [_kind(x) for x in w]:
            return f"got {g} expected {w}"
    return ""


def run(spark, con, name, query, sql, sf_dir):
    df = query(spark, sf_dir)
    if sql is None:
        n = df.count()
        return "" if n > 0 else "no rows"
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return compare(df, cursor.fetchall(), columns)


def main(argv):
    import __spark_entry__ as entry
    from pulsegrid.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(entry.queries())
    spark = build_session("check", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = run(spark, con, name, entry.queries()[name], entry.oracle_sql().get(name), sf_dir)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        mark = "FAIL" if problem else ("ok" if name in entry.oracle_sql() else "rows")
        print(f"{mark:5s} {time.time() - start:6.2f}s {name} {problem}", flush=True)
    print(f"{len(names) - failed} of {len(names)} pass")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
