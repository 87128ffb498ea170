"""Compare a Spark query result with its DuckDB oracle SQL (used by tests and tools)."""

from __future__ import annotations

import math

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if hasattr(v, "asDict"):
        return tuple(_norm(x) for x in v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(round(x, 3)) if isinstance(x, float) else str(x)) for x in row)


def _eq(a, b) -> bool:
    for x, y in zip(a, b):
        if isinstance(x, bool) or isinstance(y, bool):
            if x != y:
                return False
        elif isinstance(x, (int, float)) and isinstance(y, (int, float)):
            if not math.isclose(float(x), float(y), rel_tol=1e-6, abs_tol=1e-6):
                return False
        elif str(x) != str(y):
            return False
    return True


def compare(sdf, con, sql: str) -> tuple[bool, str]:
    """(ok, message): row count, column names and sorted row values."""
    scols = sdf.columns
    srows = [tuple(_norm(v) for v in r) for r in sdf.collect()]
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = [tuple(_norm(v) for v in r) for r in res.fetchall()]
    if sorted(scols) != sorted(dcols):
        return False, f"columns spark={scols} duck={dcols}"
    order = [dcols.index(c) for c in scols]
    drows = [tuple(r[i] for i in order) for r in drows]
    if len(srows) != len(drows):
        return False, f"rows spark={len(srows)} duck={len(drows)}"
    for a, b in zip(sorted(srows, key=_key), sorted(drows, key=_key)):
        if not _eq(a, b):
            return False, f"first diff spark={a} duck={b}"
    return True, f"{len(srows)} rows"
