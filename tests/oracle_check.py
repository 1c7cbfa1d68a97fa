"""Compare a registered Spark query with its DuckDB oracle.

Row count, column names, column types and an order-insensitive hash of the
values (columns sorted by name, each value rendered canonically) must all agree.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import sys
import time

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


SPARK_TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "float": "FLOAT",
    "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NULL" if math.isnan(v) else repr(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


def _digest(columns: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("\x1f".join(_cell(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def compare(spark, con, name: str, query, sql: str | None, sf_dir: str) -> dict:
    t0 = time.time()
    df = query(spark, sf_dir)
    spark_cols = df.columns
    spark_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    out = {"key": name, "rows": len(spark_rows), "spark_s": round(t1 - t0, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    rel = con.sql(sql)
    duck_cols = list(rel.columns)
    duck_types = {c: str(t) for c, t in zip(duck_cols, rel.types)}
    duck_rows = rel.fetchall()
    out["duck_rows"] = len(duck_rows)
    out["cols_match"] = sorted(spark_cols) == sorted(duck_cols)
    spark_types = {f.name: SPARK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    out["types_match"] = spark_types == duck_types
    out["hash_match"] = out["cols_match"] and _digest(spark_cols, spark_rows) == _digest(duck_cols, duck_rows)
    ok = out["hash_match"] and out["types_match"] and len(duck_rows) == len(spark_rows)
    out["status"] = "ok" if ok else "MISMATCH"
    if not out["cols_match"]:
        out["spark_cols"], out["duck_cols"] = spark_cols, duck_cols
    return out


def main(argv: list[str]) -> int:
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as E
    from stridelake.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    spark = build_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    sqls = E.oracle_sql()
    bad = 0
    for name, q in E.queries().items():
        if only and name not in only:
            continue
        try:
            r = compare(spark, con, name, q, sqls.get(name), sf_dir)
        except Exception as e:  # report and continue
            r = {"key": name, "status": "ERROR", "error": str(e)[:400]}
        bad += r["status"] in ("MISMATCH", "ERROR")
        print(r, flush=True)
    print("bad", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
