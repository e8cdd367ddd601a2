"""Run registered queries against their SQL: ``python -m tests.compare_sql SF [key ...]``."""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

from __spark_entry__ import oracle_sql, queries
from textlens.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def plain(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    rows = []
    for row in frame.itertuples(index=False):
        rows.append(tuple(None if v is None or v != v else (round(v, 9) if isinstance(v, float) else str(v)) for v in row))
    return sorted(rows, key=repr)


def main() -> None:
    sf, wanted = sys.argv[1], sys.argv[2:]
    folder = f"/root/testdata/sf{sf}"
    spark = local_session("check")
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    known = oracle_sql()
    failed = []
    for key, run in queries().items():
        if wanted and key not in wanted:
            continue
        start = time.time()
        try:
            got = run(spark, folder).toPandas()
        except Exception as error:  # report and go on with the next query
            failed.append(key)
            print(f"{key:28s} SPARK ERROR {str(error)[:1500]}", flush=True)
            continue
        spent = time.time() - start
        if key not in known:
            print(f"{key:28s} rows only {len(got):8d} {spent:6.1f}s", flush=True)
            continue
        start = time.time()
        try:
            expected = con.execute(known[key]).df()
        except Exception as error:
            failed.append(key)
            print(f"{key:28s} SQL ERROR {str(error)[:1500]}", flush=True)
            continue
        sql_spent = time.time() - start
        same = sorted(got.columns) == sorted(expected.columns)
        a, b = (plain(got), plain(expected)) if same else ([], [1])
        ok = a == b and len(got) > 0
        print(f"{key:28s} {'ok  ' if ok else 'DIFF'} {len(got):8d} {len(expected):8d} {spent:6.1f}s sql {sql_spent:6.1f}s", flush=True)
        if not ok:
            failed.append(key)
            print(sorted(got.columns), sorted(expected.columns))
            left, right = set(a), set(b)
            print("  only spark:", list(left - right)[:3], len(left - right))
            print("  only sql:  ", list(right - left)[:3], len(right - left))
    print("failed:", failed)


if __name__ == "__main__":
    main()
