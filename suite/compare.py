"""Run registered queries next to their SQL and report differences.

    python -m suite.compare [sf dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents"
    " embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def difference(spark_df, con, sql: str) -> str | None:
    """None when both give the same columns and the same rows, values exact."""
    names, left = normal(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    result = con.execute(sql)
    other, right = normal([d[0] for d in result.description], result.fetchall())
    if names != other:
        return f"columns {names} != {other}"
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    for a, b in zip(left, right):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{names}: {a} != {b}"
    return None


def main() -> int:
    from suite.oracle import ORACLE
    from suite.queries import QUERIES
    from tidemark.session import spark_session

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    chosen = args[1:] or list(QUERIES)
    spark = spark_session("compare", **{
        "spark.master": f"local[{os.environ.get('BENCH_CPUS', '8')}]", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for name in chosen:
        began = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLE:
                problem = difference(df, con, ORACLE[name])
                state = "ok" if problem is None else f"DIFF {problem}"
            else:
                state = f"no SQL, {df.count()} rows {df.dtypes}"
        except Exception as error:
            state = f"ERROR {str(error)[:600]}"
        bad += state.startswith(("DIFF", "ERROR"))
        print(f"{name:32s} {time.time() - began:6.2f}s {state}", flush=True)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
