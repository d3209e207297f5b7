"""Run registered queries beside their SQL and compare; ``python -m tests.oracle [names]`` prints a report."""

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def expected(sql, folder=FOLDER):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    cursor = connection.execute(sql)
    return [d[0] for d in cursor.description], cursor.fetchall()


def canonical(value):
    if isinstance(value, bool) or value is None:
        return repr(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(0.0 if value == 0 else float(f"{value:.12g}"))
    if isinstance(value, (bytearray, bytes)):
        return bytes(value).hex()
    return repr(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(canonical(row[i]) for i in order) for row in rows)


def compare(spark, name, folder=FOLDER):
    """None when equal, else a description of the difference."""
    import __spark_entry__ as entry

    df = entry.queries()[name](spark, folder)
    got = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None if got else "no rows"
    names, want = expected(sql, folder)
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    a, b = rows_of(df.columns, got), rows_of(names, want)
    differing = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(differing)} of {len(a)} rows differ: {differing[:3]} columns {sorted(names)}" if differing else None


def main(names):
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "12g").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    failed = 0
    for name in names or entry.queries():
        began = time.time()
        try:
            problem = compare(spark, name)
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - began:.1f}s {'(rows only) ' if name not in entry.oracle_sql() else ''}{problem or ''}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main(sys.argv[1:])
