"""Run registered queries on Spark and their SQL on DuckDB and compare all rows.

    python tests/oracle_check.py [sf_dir] [name prefix ...]
"""

from __future__ import annotations

import datetime
import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def make_spark(cpus: str = "8"):
    from pyspark.sql import SparkSession

    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("check")
             .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
             .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "12g")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def make_duck(sf: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def cell(v):
    if isinstance(v, bool) or v is None:
        return repr(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}"
    if isinstance(v, int):
        return str(v)
    if hasattr(v, "as_integer_ratio"):
        return f"{float(v):.6g}"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(cell(x) for x in v) + "]"
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted("\x1f".join(cell(r[i]) for i in order) for r in rows)


def check(spark, con, name, sf, queries, sql):
    started = time.time()
    df = queries[name](spark, sf)
    got_cols, got = rows_of(df.columns, df.collect())
    took = time.time() - started
    if name not in sql:
        return "rows", len(got), took, ""
    rel = con.execute(sql[name])
    want_cols, want = rows_of([d[0] for d in rel.description], rel.fetchall())
    if got_cols != want_cols:
        return "COLUMNS", len(got), took, f"{got_cols} != {want_cols}"
    if got != want:
        extra = [r for r in set(got) - set(want)][:2]
        missing = [r for r in set(want) - set(got)][:2]
        return "DIFF", len(got), took, f"{len(got)} vs {len(want)} rows\n   spark only: {extra}\n   sql only:   {missing}"
    return "ok", len(got), took, ""


def compile_failures(seen=[0]):
    """Note when generated code was too large for a query (log file in $ERR)."""
    path = os.environ.get("ERR")
    if not path:
        return ""
    with open(path, errors="replace") as f:
        now = sum("grows beyond" in line for line in f)
    fresh, seen[0] = now - seen[0], now
    return f" [{fresh} stages without generated code]" if fresh else ""


def main():
    from __spark_entry__ import oracle_sql, queries

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:])
    spark, con = make_spark(), make_duck(sf)
    q, sql = queries(), oracle_sql()
    bad = 0
    for name in q:
        if prefixes and not name.startswith(prefixes):
            continue
        try:
            state, n, took, note = check(spark, con, name, sf, q, sql)
        except Exception as e:
            state, n, took, note = "FAIL", 0, 0.0, str(e)[:700]
            if os.environ.get("TRACE"):
                traceback.print_exc()
        bad += state not in ("ok", "rows")
        note += compile_failures()
        print(f"{state:8} {name:34} {n:8} rows {took:6.2f}s {note[:1500]}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
