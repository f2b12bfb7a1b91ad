"""Run registered queries against their SQL checks: python tests/compare.py [sf] [name ...]"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def normal(value):
    if value is None or value is pd.NA or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, (list, tuple)) or type(value).__name__ == "ndarray":
        return tuple(normal(v) for v in value)
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float):
        return round(value, 9) + 0.0
    if hasattr(value, "isoformat"):
        return value.isoformat()[:19]
    return value


def rows_of(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    return sorted((tuple(normal(v) for v in r) for r in pdf[cols].astype(object).itertuples(index=False)), key=repr)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def kinds(pdf_types: dict[str, str]) -> dict[str, str]:
    return dict(sorted(pdf_types.items()))


def check(spark, name, query, text, sf_dir, con) -> tuple[str, float, float, int]:
    start = time.time()
    df = query(spark, sf_dir)
    got = df.toPandas()
    spent = time.time() - start
    if text is None:
        return "rows only", spent, 0.0, len(got)
    start = time.time()
    want = con.execute(text).df()
    oracle = time.time() - start
    if sorted(got.columns) != sorted(want.columns):
        return f"COLUMNS {sorted(got.columns)} {sorted(want.columns)}", spent, oracle, len(got)
    a, b = rows_of(got), rows_of(want)
    if a != b:
        only_a, only_b = set(a) - set(b), set(b) - set(a)
        return (f"DIFF {len(a)} vs {len(b)}; spark only {sorted(only_a, key=repr)[:2]} sql only {sorted(only_b, key=repr)[:2]}",
                spent, oracle, len(got))
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    duck = {r[0]: r[1] for r in con.execute(f"DESCRIBE {text}").fetchall()}
    same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE"}
    off = {n: (t, duck[n]) for n, t in types.items() if same.get(t, duck[n]) != duck[n]}
    return ("ok" if not off else f"ok TYPES {off}"), spent, oracle, len(got)


def main() -> None:
    import __spark_entry__ as entry
    from voxelry.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session("compare", "local[8]", 8, **{"spark.ui.enabled": "false", "spark.driver.memory": "12g",
                                                       "spark.sql.execution.pyspark.udf.faulthandler.enabled": "true"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    names = sys.argv[2:] or list(queries)
    bad = 0
    for name in names:
        try:
            result, t, o, n = check(spark, name, queries[name], oracles.get(name), sf_dir, con)
        except Exception as exc:  # noqa: BLE001 - a report of all queries is wanted
            result, t, o, n = f"ERROR {type(exc).__name__} {str(exc)[:700]}", 0.0, 0.0, 0
        bad += not result.startswith(("ok", "rows only"))
        print(f"{name:28s} {n:8d} rows  spark {t:6.2f}s  sql {o:6.2f}s  {result}", flush=True)
    print("failed:", bad)
    spark.stop()


if __name__ == "__main__":
    main()
