"""Runs queries beside their SQL twins: ``python -m tests.oracle [-s DIR] [prefix ...]``."""

from __future__ import annotations

import argparse
import math
import time

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connection(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def _plain(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    if isinstance(v, float):
        return float(f"{v:.9g}")
    return v


def rows(pdf: pd.DataFrame) -> list[tuple]:
    pdf = pdf[sorted(pdf.columns)]
    return sorted((tuple(_plain(v) for v in r) for r in pdf.itertuples(index=False, name=None)), key=repr)


def compare(got: pd.DataFrame, want: pd.DataFrame) -> list[str]:
    if sorted(got.columns) != sorted(want.columns):
        return [f"columns {sorted(got.columns)} != {sorted(want.columns)}"]
    problems = []
    for c in sorted(got.columns):
        if got[c].dtype != want[c].dtype and len(got) and not (got[c].isna().any() or want[c].isna().any()):
            problems.append(f"type of {c}: {got[c].dtype} != {want[c].dtype}")
    a, b = rows(got), rows(want)
    if len(a) != len(b):
        problems.append(f"rows {len(a)} != {len(b)}")
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
        problems.append(f"values differ: {diff}" if diff else "values differ at the end")
    return problems


def main() -> None:
    from shelfwise.session import build_session
    import __spark_entry__ as entry

    ap = argparse.ArgumentParser()
    ap.add_argument("-s", default="/root/testdata/sf0.01")
    ap.add_argument("prefix", nargs="*")
    args = ap.parse_args()
    spark = build_session(master="local[8]", shuffle_partitions=8,
                          **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connection(args.s), entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if args.prefix and not any(name == p or name.startswith(p + "_") for p in args.prefix):
            continue
        t = time.time()
        try:
            got = fn(spark, args.s).toPandas()
            took = time.time() - t
            problems = compare(got, con.execute(sql[name]).df()) if name in sql else []
        except Exception as e:  # noqa: BLE001
            took, got, problems = time.time() - t, [], [f"{type(e).__name__}: {str(e)[:1500]}"]
        bad += bool(problems)
        mark = "BAD " if problems else ("ok  " if name in sql else "rows")
        print(f"{mark} {name:28s} {len(got):7d} rows {took:6.2f}s {'; '.join(problems)[:1500]}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
