"""Compare registered queries with their DuckDB oracle on one scale folder.

    python -m tests.oracle_check /root/testdata/sf0.01 [key ...]

Prints one line per key: rows on both sides and whether the sorted,
order-insensitive values agree.
"""

from __future__ import annotations

import math
import sys
import time
from datetime import datetime
from decimal import Decimal

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.10g}")
    if isinstance(v, Decimal):
        return str(v.normalize()) if v == v.to_integral() else str(v)
    if isinstance(v, datetime):
        return v.replace(tzinfo=None).isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, sf_dir: str, keys=None) -> dict[str, dict]:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    qs, oracle = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    report = {}
    for key in keys or list(qs):
        t0 = time.time()
        try:
            df = qs[key](spark, sf_dir)
            cols = df.columns
            got = rows_of(cols, [tuple(r) for r in df.collect()])
        except Exception as exc:  # noqa: BLE001 - report and go on
            report[key] = {"error": f"spark: {exc!r}"[:500]}
            print(key, report[key], flush=True)
            continue
        entry_ = {"spark_rows": len(got), "sec": round(time.time() - t0, 2)}
        if key in oracle:
            try:
                res = con.execute(oracle[key])
                ocols = [d[0] for d in res.description]
                want = rows_of(ocols, res.fetchall())
                entry_.update(oracle_rows=len(want), schema=sorted(cols) == sorted(ocols),
                              values=got == want)
                if not entry_["schema"]:
                    entry_["cols"] = (sorted(set(cols) - set(ocols)), sorted(set(ocols) - set(cols)))
                elif not entry_["values"]:
                    diff = [(a, b) for a, b in zip(got, want) if a != b][:2]
                    entry_["first_diff"] = str(diff)[:800]
            except Exception as exc:  # noqa: BLE001
                entry_["error"] = f"duckdb: {exc!r}"[:500]
        report[key] = entry_
        print(key, entry_, flush=True)
    return report


if __name__ == "__main__":
    from cardwatch.config import local_session
    spark = local_session()
    compare(spark, sys.argv[1], sys.argv[2:] or None)
