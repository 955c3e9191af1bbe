"""Compares registered queries with their SQL, value by value.

python -m tests.compare [--large] [sf_dir] [query ...]

--large takes the ways meant for large input (range ranking, salted joins).
"""

import datetime
import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    if hasattr(v, "as_integer_ratio"):
        return round(float(v), 9)
    return str(v)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_value(r[i]) for i in order) for r in rows), key=repr)


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def differences(df, con, sql):
    """Empty string if equal, else what differs first."""
    got = df.collect()
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    want = result.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    a, b = _rows(df.columns, got), _rows(names, want)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            return f"{sorted(names)}\n  spark {str(x)[:600]}\n  sql   {str(y)[:600]}"
    return "" if a else "no rows"


def main():
    import __spark_entry__ as entry
    from threadglean.session import get_spark

    args = [a for a in sys.argv[1:] if a != "--large"]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    spark = get_spark("compare", "local[8]", spark__sql__shuffle__partitions=8, spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    if "--large" in sys.argv:
        spark.conf.set("threadglean.smallInputBytes", "0")
        spark.conf.set("threadglean.hotRowsPerTask", "3")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    con, queries, sql = connect(sf_dir), entry.queries(), entry.oracle_sql()
    bad = 0
    for name in args[1:] or queries:
        begin = time.time()
        try:
            df = queries[name](spark, sf_dir)
            diff = differences(df, con, sql[name]) if name in sql else f"(no SQL) {df.count()} rows"
        except Exception as e:
            diff = f"{type(e).__name__}: {str(e)[:1500]}"
        ok = not diff or diff.startswith("(no SQL)")
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - begin:.2f}s {diff}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
