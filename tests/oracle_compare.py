"""Spark query vs DuckDB oracle: row count, column names, types, order-insensitive values.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return f"{v:.9g}"
    if isinstance(v, bool):
        return "T" if v else "F"
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def compare(spark, name, fn, sql, sf_dir, con):
    t0 = time.time()
    df = fn(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    scols = df.columns
    t1 = time.time()
    res = {"name": name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    rel = con.sql(sql)
    dcols = rel.columns
    drows = rel.fetchall()
    res["oracle_rows"] = len(drows)
    if sorted(scols) != sorted(dcols):
        res["status"] = f"COLUMNS spark={sorted(scols)} duck={sorted(dcols)}"
        return res
    smap = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
            "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
            "float": "FLOAT", "smallint": "SMALLINT", "date": "DATE"}
    st = {c: smap.get(t, t) for c, t in df.dtypes}
    dt = {c: str(t) for c, t in zip(dcols, rel.types)}
    tdiff = {c: (st[c], dt[c]) for c in st if st[c] != dt.get(c)}
    hs, ls = digest(scols, srows)
    hd, ld = digest(dcols, drows)
    if len(srows) != len(drows):
        res["status"] = "ROWCOUNT"
    elif hs != hd:
        diff = [(a, b) for a, b in zip(ls, ld) if a != b][:3]
        res["status"] = f"VALUES e.g. {diff}"
    elif tdiff:
        res["status"] = f"TYPES {tdiff}"
    else:
        res["status"] = "ok"
    return res


def main(argv):
    from strata.session import get_spark
    import __spark_entry__ as E

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    if os.environ.get("PLAIN_SESSION"):   # a session as a caller would build it, no presets
        from pyspark.sql import SparkSession

        spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
                 .config("spark.ui.showConsoleProgress", "false").getOrCreate())
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = get_spark("local[8]", 8)
    con = duck(sf_dir)
    qs, orc = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        try:
            r = compare(spark, name, qs[name], orc.get(name), sf_dir, con)
        except Exception as exc:  # report and continue
            r = {"name": name, "status": f"ERROR {type(exc).__name__}: {str(exc)[:400]}"}
        bad += r["status"] not in ("ok", "rows-only")
        print(r, flush=True)
    print(f"{len(names or qs) - bad} passed, {bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
