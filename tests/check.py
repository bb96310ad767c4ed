"""Compare registered queries with their SQL in DuckDB: ``python tests/check.py SF_DIR [name ...]``."""

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def database(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if value is not None and type(value).__name__ == "Decimal":
        return float(value)
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(plain(r[i]) for i in order) for r in rows),
                         key=lambda t: tuple((v is None, str(v)) for v in t))


def compare(spark, con, name, sf_dir, query, sql):
    df = query(spark, sf_dir)
    ours = canonical(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    theirs = canonical([d[0] for d in cursor.description], cursor.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"rows {len(ours[1])} != {len(theirs[1])}"
    for a, b in zip(ours[1], theirs[1]):
        if a != b:
            return f"first difference {dict(zip(ours[0], a))} != {dict(zip(ours[0], b))}"
    return None if ours[1] else "no rows"


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from surveypulse.session import local_session

    spark = local_session(8)
    sf_dir = sys.argv[1]
    con = database(sf_dir)
    sqls = oracle_sql()
    for name, query in queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, name, sf_dir, query, sqls[name])
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:22s} {time.time() - start:6.2f}s {problem or 'same'}", flush=True)
