"""Local stand-in of the correctness gate: run a named query in Spark and its SQL in DuckDB
over the same parquet folder, and compare row count, schema and an order-free value hash."""

from __future__ import annotations

import hashlib
import math
import os

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9) + 0.0)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def frame_digest(cols: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def compare(spark, con, name: str, df, sql_text: str) -> dict:
    pdf_rows = [tuple(r) for r in df.collect()]
    scols = df.columns
    res = con.execute(sql_text)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    out = {"name": name, "spark_rows": len(pdf_rows), "duck_rows": len(drows),
           "cols_match": sorted(scols) == sorted(dcols)}
    out["hash_match"] = out["cols_match"] and frame_digest(scols, pdf_rows) == frame_digest(dcols, drows)
    if not out["cols_match"]:
        out["spark_cols"], out["duck_cols"] = scols, dcols
    if out["cols_match"] and not out["hash_match"]:
        order_s = sorted(range(len(scols)), key=lambda i: scols[i])
        order_d = sorted(range(len(dcols)), key=lambda i: dcols[i])
        ss = sorted("|".join(_norm(r[i]) for i in order_s) for r in pdf_rows)
        dd = sorted("|".join(_norm(r[i]) for i in order_d) for r in drows)
        diff = [(a, b) for a, b in zip(ss, dd) if a != b][:3]
        out["example_diff"] = diff
        out["cols"] = sorted(scols)
    return out
