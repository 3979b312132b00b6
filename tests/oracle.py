"""Compare registered queries with their SQL twins in DuckDB."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
PLAIN = {"BIGINT", "DOUBLE", "VARCHAR", "BOOLEAN"}


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _norm(value):
    if value is None:
        return (0, "")
    if isinstance(value, float):
        return (1, "nan") if math.isnan(value) else (1, f"{value:.9g}")
    return (1, str(value))


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in data)


def compare(spark, con, name, fn, sql, folder) -> tuple[bool, str]:
    started = time.time()
    df = fn(spark, folder)
    got_rows = [tuple(r) for r in df.collect()]
    spark_sec = time.time() - started
    if sql is None:
        return bool(got_rows), f"{name}: {len(got_rows)} rows, no SQL, {spark_sec:.1f}s"
    started = time.time()
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    types = [str(d[1]) for d in cur.description]
    want_rows = cur.fetchall()
    sql_sec = time.time() - started
    if sorted(columns) != sorted(df.columns):
        return False, f"{name}: columns {sorted(df.columns)} vs {sorted(columns)}"
    odd = [f"{c}:{t}" for c, t in zip(columns, types) if t not in PLAIN and t not in ("NUMBER", "STRING", "bool")]
    got, want = rows(df.columns, got_rows), rows(columns, want_rows)
    note = f" types {odd}" if odd else ""
    if got == want:
        return True, f"{name}: {len(got)} rows ok, spark {spark_sec:.1f}s sql {sql_sec:.1f}s{note}"
    extra = [r for r in got if r not in set(want)][:3]
    lacking = [r for r in want if r not in set(got)][:3]
    return False, f"{name}: {len(got)} vs {len(want)} rows\n  spark only {extra}\n  sql only   {lacking}{note}"


def main() -> None:
    from millrace.session import build_session
    from __spark_entry__ import oracle_sql, queries

    folder, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session("oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("OFF")
    con, sqls, bad = connect(folder), oracle_sql(), 0
    for name, fn in queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        try:
            ok, text = compare(spark, con, name, fn, sqls.get(name), folder)
        except Exception as exc:  # report and go on with the next query
            ok, text = False, f"{name}: {type(exc).__name__} {str(exc)[:900]}"
        bad += not ok
        print("PASS" if ok else "FAIL", text, flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
