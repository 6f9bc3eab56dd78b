"""Runs the registered queries against their SQL: python tests/check_queries.py [sf_dir] [name ...]"""

import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(sf_dir):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return db


def compare(spark, db, sf_dir, name, query, sql):
    """None when both results are the same multiset of rows, else what differs."""
    frame = query(spark, sf_dir)
    columns = sorted(frame.columns)
    ours = [tuple(r[c] for c in columns) for r in frame.collect()]
    if sql is None:
        return None if ours else "no rows"
    cursor = db.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != columns:
        return f"columns {columns} and {sorted(names)}"
    at = [names.index(c) for c in columns]
    theirs = [tuple(r[i] for i in at) for r in cursor.fetchall()]
    types = {type(v) for r in ours[:50] for v in r} | {type(v) for r in theirs[:50] for v in r}
    if types - {int, str, float, bool, type(None)}:
        return f"types {types}"
    key = repr
    ours, theirs = sorted(ours, key=key), sorted(theirs, key=key)
    if ours != theirs:
        diff = [(a, b) for a, b in zip(ours, theirs) if a != b][:2]
        return f"{len(ours)} and {len(theirs)} rows; {str(diff)[:1500]}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(entry.queries())
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    db = database(sf_dir)
    bad = 0
    for name in wanted:
        start = time.time()
        problem = compare(
            session, db, sf_dir, name, entry.queries()[name], entry.oracle_sql().get(name)
        )
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name:30s} {time.time() - start:6.1f}s {problem or ''}", flush=True)
    sys.exit(bad)
