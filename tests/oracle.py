"""Run queries in Spark and their texts in DuckDB and compare rows and types.

    python -m tests.oracle [folder] [query ...]
"""

import math
import os
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

_KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def session(cores="8"):
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("barloom-tests")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def differences(df, con, sql) -> list[str]:
    """What differs between a DataFrame and a SQL text; empty when they agree."""
    cursor = con.execute(sql)
    theirs_cols = [(d[0], str(d[1])) for d in cursor.description]
    theirs = cursor.fetchall()
    ours_cols = [(f.name, _kind(f.dataType.simpleString())) for f in df.schema]
    found = []
    if sorted(ours_cols) != sorted(theirs_cols):
        found.append(f"columns {sorted(ours_cols)} vs {sorted(theirs_cols)}")
    names = sorted(name for name, _ in ours_cols)
    if names != sorted(name for name, _ in theirs_cols):
        return found
    ours = Counter(tuple(_value(row[n]) for n in names) for row in df.collect())
    places = [[name for name, _ in theirs_cols].index(n) for n in names]
    other = Counter(tuple(_value(row[p]) for p in places) for row in theirs)
    if ours != other:
        found.append(
            f"{ours.total()} vs {other.total()} rows; only Spark {list((ours - other).items())[:3]}; "
            f"only DuckDB {list((other - ours).items())[:3]}"
        )
    elif not ours:
        found.append("both are empty")
    return found


def _kind(name):
    return _KINDS.get(name, name.upper())


def _value(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    return v


def main(argv):
    sys.path.insert(0, os.getcwd())
    import __spark_entry__ as entry

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    queries, texts = entry.queries(), entry.oracle_sql()
    spark, con = session(), connect(folder)
    bad = 0
    for name in argv[1:] or queries:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            if name in texts:
                found = differences(df, con, texts[name])
            else:
                found = [] if df.count() else ["no rows"]
        except Exception as problem:
            found = [f"{type(problem).__name__}: {str(problem)[:1500]}"]
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.2f}s {'; '.join(found)}"[:2500], flush=True)
    print(f"{bad} of {len(argv[1:] or queries)} differ")


if __name__ == "__main__":
    main(sys.argv[1:])
