"""Run queries beside their SQL and compare. ``python tests/oracle.py [sf] [name ...]`` checks by hand."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def sf_dir(sf: str) -> str:
    return f"/root/testdata/sf{sf}"


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(df, con, sql: str) -> str | None:
    """None when both give the same columns and rows, else what differs."""
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    answer = con.execute(sql)
    names = [d[0] for d in answer.description]
    want = rows_of(names, answer.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if got != want:
        extra = [r for r in got if r not in set(want)][:3]
        missing = [r for r in want if r not in set(got)][:3]
        return f"{len(got)} rows vs {len(want)}; only ours {extra}; only theirs {missing}"
    if not got:
        return "no rows"
    return None


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    queries, sql = e.queries(), e.oracle_sql()
    names = [n for n in queries if len(sys.argv) < 3 or any(n == a or (a.endswith("*") and n.startswith(a[:-1])) for a in sys.argv[2:])]
    spark = (SparkSession.builder.master(os.environ.get("ORACLE_MASTER", "local[8]")).config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir(sf))
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir(sf))
            if name in sql:
                problem = compare(df, con, sql[name])
            else:
                n = df.count()
                problem = None if n else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += problem is not None
        kind = "sql " if name in sql else "rows"
        print(f"{'ok  ' if problem is None else 'BAD '} {kind} {time.time() - start:6.1f}s {name} {(problem or '')[:1500]}", flush=True)
    print(f"{len(names)} queries, {bad} bad")


if __name__ == "__main__":
    main()
