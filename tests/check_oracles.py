"""Run registered queries against their SQL: ``python tests/check_oracles.py [sf_dir] [name ...]``."""

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(x):
        if isinstance(x, float):
            return "nan" if math.isnan(x) else f"{x + 0.0:.6f}"
        return repr(x)

    return sorted(tuple(value(row[i]) for i in order) for row in rows)


def compare(df, con, sql):
    """None when equal, else what differs."""
    got = canonical([tuple(r) for r in df.collect()], df.columns)
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    want = canonical(result.fetchall(), names)
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if got == want:
        return None
    only_got, only_want = sorted(set(got) - set(want)), sorted(set(want) - set(got))
    return f"{len(got)} rows, {len(want)} wanted; e.g. {str(only_got[:2])[:400]} / {str(only_want[:2])[:400]}"


def session():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(folder, names):
    import __spark_entry__ as entry

    spark, con = session(), connect(folder)
    failed = []
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        sql = entry.oracle_sql().get(name)
        start = time.time()
        try:
            df = query(spark, folder)
            if sql is None:
                verdict = f"{df.count()} rows, no SQL"
            else:
                problem = compare(df, con, sql)
                verdict = "ok" if problem is None else f"DIFFERS {problem}"
        except Exception as error:  # noqa: BLE001
            verdict = f"FAILED {type(error).__name__}: {str(error)[:600]}"
        if verdict.startswith(("DIFFERS", "FAILED")):
            failed.append(name)
        print(f"{name:28s} {time.time() - start:6.1f}s  {verdict}", flush=True)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    args = sys.argv[1:]
    sys.exit(main(args[0] if args else "/root/testdata/sf0.01", set(args[1:])))
