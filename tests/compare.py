"""Run driver queries on Spark and their SQL on DuckDB, and compare the rows.

    python tests/compare.py [scale factor folder] [name part ...]
"""

from __future__ import annotations

import datetime
import decimal
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(folder: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def ordered(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    cells = [tuple(plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(cells, key=lambda r: tuple((v is not None, str(v)) for v in r))


def difference(df, con, sql) -> str | None:
    """None if both give the same rows, else what differs first."""
    got_names, got = ordered(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    want_names, want = ordered([d[0] for d in cursor.description], cursor.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}; only here {sorted(map(str, set(got) - set(want)))[:3]}, only expected {sorted(map(str, set(want) - set(got)))[:3]}"
    for a, b in zip(got, want):
        if a != b:
            return f"{a} != {b}"
    for a, b in zip(got, want):
        for x, y in zip(a, b):
            if type(x) is not type(y):
                return f"types of {a} and {b}"
    return None


def main() -> int:
    from pyspark.sql import SparkSession

    from queries import ORACLES, QUERIES
    from riskframe.sources.scratch import use_scratch_dir

    use_scratch_dir("/tmp/checkpoints")
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = database(folder)
    bad = 0
    for name, build in QUERIES.items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            df = build(spark, folder)
            if name in ORACLES:
                problem = difference(df, con, ORACLES[name])
                rows = con.execute(f"SELECT count(*) FROM ({ORACLES[name]})").fetchall()[0][0]
            else:
                rows, problem = df.count(), None
        except Exception as error:  # noqa: BLE001
            rows, problem = "?", f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        state = "ok" if problem is None else "DIFF " + problem
        mark = "" if name in ORACLES else " (rows only)"
        print(f"{name}: {rows} rows {time.time() - start:.1f}s {state}{mark}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main()))
