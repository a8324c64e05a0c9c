"""Run every query and its SQL side by side: ``python -m catalog.check [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from catalog.oracle import ORACLES
from catalog.queries import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{sf_dir}/{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(pdf: pd.DataFrame) -> list[tuple]:
    def cell(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
            return None
        return float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    pdf = pdf[sorted(pdf.columns)]
    return sorted((tuple(map(cell, row)) for row in pdf.astype(object).itertuples(index=False)), key=repr)


def compare(spark, con, name: str, sf_dir: str) -> tuple[str, int, float]:
    start = time.time()
    got = QUERIES[name](spark, sf_dir).toPandas()
    took = time.time() - start
    if name not in ORACLES:
        return "no SQL", len(got), took
    want = con.execute(ORACLES[name]).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}", len(got), took
    a, b = canonical(got), canonical(want)
    if a != b:
        only_a = [x for x in a if x not in set(b)][:2]
        only_b = [x for x in b if x not in set(a)][:2]
        return f"DIFFERS rows {len(a)} / {len(b)}\n    spark {only_a}\n    sql   {only_b}", len(got), took
    return "ok" if a else "ok but EMPTY", len(got), took


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in sys.argv[2:] or QUERIES:
        try:
            verdict, rows, took = compare(spark, con, name, sf_dir)
        except Exception as e:  # noqa: BLE001 - a report, one line per query
            verdict, rows, took = f"ERROR {type(e).__name__}: {str(e)[:400]}", -1, 0.0
        bad += not verdict.startswith(("ok", "no SQL"))
        print(f"{name:28s} {rows:7d} rows {took:6.2f}s  {verdict}", flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(main())
