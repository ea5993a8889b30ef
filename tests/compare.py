"""Runs the queries and their SQL side by side. ``python -m tests.compare [sf_dir] [names…]``"""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return connection


def text(value) -> str:
    if value is None or value is pd.NaT or value is pd.NA or value != value:
        return "null"
    if isinstance(value, float):
        return repr(value)
    return str(value).removesuffix(" 00:00:00")


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, values as text, rows in order."""
    names = sorted(frame.columns)
    rows = sorted(tuple(text(v) for v in row) for row in frame[names].astype(object).itertuples(index=False))
    return pd.DataFrame(rows, columns=names, dtype=object)


def kinds(frame: pd.DataFrame) -> dict[str, str]:
    return {c: frame[c].dtype.kind for c in sorted(frame.columns)}


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    a, b = canonical(got), canonical(want)
    if not a.equals(b):
        wrong = [c for c in a.columns if not a[c].equals(b[c])]
        rows = a.index[(a != b).any(axis=1)]
        return f"values differ in {wrong}, {len(rows)} rows, first:\n{a.loc[rows[:2]].to_dict('records')}\n{b.loc[rows[:2]].to_dict('records')}"
    return None


def main() -> None:
    import __spark_entry__ as entry
    from footfall.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    sql, connection = entry.oracle_sql(), oracle_connection(sf_dir)
    names = sys.argv[2:] or list(entry.queries())
    bad = 0
    for name in names:
        start = time.time()
        try:
            got = entry.queries()[name](spark, sf_dir).toPandas()
            took = time.time() - start
            if name not in sql:
                print(f"{name:26} rows only {len(got):7} {took:6.2f}s", flush=True)
                continue
            want = connection.execute(sql[name]).df()
            problem = difference(got, want)
            odd = {c: (k, kinds(want)[c]) for c, k in kinds(got).items() if kinds(want).get(c) != k} if not problem else ""
            print(f"{name:26} {'ok' if not problem else 'WRONG ' + problem} {len(got):7} {took:6.2f}s {odd or ''}", flush=True)
            bad += bool(problem)
        except Exception as error:  # report and go on
            print(f"{name:26} FAILED {str(error)[:1500]}", flush=True)
            bad += 1
    print(f"{bad} of {len(names)} wrong")


if __name__ == "__main__":
    main()
