"""Run queries() on Spark and oracle_sql() on DuckDB over the same tables and compare.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
Prints one line per query: name, status, rows, seconds.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


STRICT = False  # --strict: compare floats exactly (no re-rounding)


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v.is_integer():
            return int(v)
        return v if STRICT else round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, bytes):
        return v.hex()
    return v


def canon(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_norm(v) for v in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def compare(spark_df: pd.DataFrame, oracle_df: pd.DataFrame) -> str:
    if sorted(spark_df.columns) != sorted(oracle_df.columns):
        return f"COLUMNS spark={sorted(spark_df.columns)} oracle={sorted(oracle_df.columns)}"
    if len(spark_df) != len(oracle_df):
        return f"ROWCOUNT spark={len(spark_df)} oracle={len(oracle_df)}"
    a, b = canon(spark_df), canon(oracle_df)
    diffs = [(x, y) for x, y in zip(a, b) if x != y]
    if diffs:
        return f"VALUES {len(diffs)} rows differ, first: spark={diffs[0][0]} oracle={diffs[0][1]}"
    return "OK"


def main() -> None:
    import __spark_entry__ as se
    from vigil.session import build_session

    global STRICT
    STRICT = "--strict" in sys.argv
    args = [a for a in sys.argv[1:] if a not in ("--plain", "--strict")]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or sorted(se.queries())
    if "--plain" in sys.argv:  # a bare session, as an outside driver would create it
        from pyspark.sql import SparkSession

        spark = (SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
                 .config("spark.ui.enabled", "false").getOrCreate())
    else:
        spark = build_session(master="local[8]")
    con = duck(sf_dir)
    qs, orc = se.queries(), se.oracle_sql()
    bad = 0
    for name in names:
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir).toPandas()
        except Exception as e:  # report and continue
            print(f"\n{name:28s} SPARK-ERROR {type(e).__name__}: {str(e)[:300]}", flush=True)
            bad += 1
            continue
        dt = time.time() - t0
        if name not in orc:
            print(f"\n{name:28s} ROWS-ONLY rows={len(sdf)} {dt:.1f}s", flush=True)
            continue
        try:
            odf = con.execute(orc[name]).df()
        except Exception as e:
            print(f"\n{name:28s} ORACLE-ERROR {type(e).__name__}: {str(e)[:300]}", flush=True)
            bad += 1
            continue
        res = compare(sdf, odf)
        bad += res != "OK"
        print(f"\n{name:28s} {res} rows={len(sdf)} {dt:.1f}s", flush=True)
    print(f"mismatches: {bad}")


if __name__ == "__main__":
    main()
