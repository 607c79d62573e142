"""Compare registered queries with their SQL, value for value."""

import sys
import tempfile
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(repr(tuple(row[i] for i in order)) for row in rows)


def spark_rows(df):
    return rows_of(df.columns, [tuple(row) for row in df.collect()])


def sql_rows(connection, sql):
    cursor = connection.execute(sql)
    return rows_of([d[0] for d in cursor.description], cursor.fetchall())


def difference(df, connection, sql):
    """None when equal, else a short account of the difference."""
    got_columns, got = spark_rows(df)
    want_columns, want = sql_rows(connection, sql)
    if got_columns != want_columns:
        return f"columns {got_columns} <> {want_columns}"
    if got == want:
        return None
    extra = sorted(set(got) - set(want))[:2]
    lacking = sorted(set(want) - set(got))[:2]
    return f"{len(got)} rows <> {len(want)} rows; only here {extra}; only there {lacking}"


def main(sf_dir, names):
    from pyspark.sql import SparkSession

    from ledgerloom.catalogue import load_all

    queries, oracles = load_all()
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="ledgerloom-check-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    bad = 0
    for name, fn in queries.items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in oracles:
                result = difference(df, connection, oracles[name])
            else:
                result = None if df.count() >= 0 else "no rows"
        except Exception as problem:
            result = f"{type(problem).__name__}: {str(problem)[:1500]}"
        bad += result is not None
        print(f"{'ok ' if result is None else 'BAD'} {name} {time.time() - start:.1f}s {result or ''}")
    print("bad:", bad)


if __name__ == "__main__":
    main(sys.argv[1], set(sys.argv[2:]))
