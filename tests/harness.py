"""Spark-vs-DuckDB comparison of registered queries (mirrors the driver's check).

Run as a script:  python -m tests.harness [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb
import pandas as pd

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
            return None
        return round(v, 6)
    if isinstance(v, pd.Timestamp):
        v = v.to_pydatetime().replace(tzinfo=None)
    if isinstance(v, dt.datetime):
        v = v.replace(tzinfo=None)
        return v.date().isoformat() if v.time() == dt.time(0) else v.isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    return v


def rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = [tuple(_norm(r[c]) for c in cols) for r in df.to_dict("records")]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def spark_types(schema) -> dict[str, str]:
    m = {"long": "int64", "integer": "int32", "short": "int16", "byte": "int8", "double": "float64",
         "float": "float32", "string": "string", "date": "date", "timestamp": "timestamp",
         "timestamp_ntz": "timestamp", "boolean": "bool"}
    return {f.name: m.get(f.dataType.typeName(), f.dataType.typeName()) for f in schema.fields}


def duck_types(rel) -> dict[str, str]:
    m = {"BIGINT": "int64", "INTEGER": "int32", "SMALLINT": "int16", "TINYINT": "int8",
         "DOUBLE": "float64", "FLOAT": "float32", "VARCHAR": "string", "DATE": "date",
         "TIMESTAMP": "timestamp", "BOOLEAN": "bool"}
    out = {}
    for name, t in zip(rel.columns, rel.types):
        t = str(t)
        out[name] = "array" if t.endswith("[]") else m.get(t, t)
    return out


def compare_types(st: dict[str, str], dt_: dict[str, str]) -> str | None:
    bad = {k: (st[k], dt_.get(k)) for k in st if st[k] != dt_.get(k)}
    return f"types differ: {bad}" if bad else None


def compare(spark_pdf: pd.DataFrame, oracle_pdf: pd.DataFrame) -> str | None:
    if sorted(spark_pdf.columns) != sorted(oracle_pdf.columns):
        return f"columns differ: {sorted(spark_pdf.columns)} vs {sorted(oracle_pdf.columns)}"
    if len(spark_pdf) != len(oracle_pdf):
        return f"row count {len(spark_pdf)} vs {len(oracle_pdf)}"
    a, b = rows(spark_pdf), rows(oracle_pdf)
    for i, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return f"row {i} differs: {x} vs {y}"
    return None


def check(spark, sf_dir: str, names: list[str] | None = None, verbose: bool = True) -> dict:
    from __spark_entry__ import oracle_sql, queries
    qs, sqls = queries(), oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            stypes = spark_types(sdf.schema)
            sp = sdf.toPandas()
        except Exception as e:  # noqa: BLE001
            results[name] = f"spark error: {type(e).__name__}: {str(e)[:300]}"
            print(name, results[name]) if verbose else None
            continue
        ts = time.time() - t0
        if name not in sqls:
            results[name] = None
            print(f"{name:32s} rows={len(sp):6d} spark={ts:5.2f}s (no oracle)") if verbose else None
            continue
        try:
            rel = con.sql(sqls[name])
            dtypes = duck_types(rel)
            ora = rel.df()
        except Exception as e:  # noqa: BLE001
            results[name] = f"oracle error: {str(e)[:300]}"
            print(name, results[name]) if verbose else None
            continue
        err = compare(sp, ora)
        if err is None:
            err = compare_types(stypes, dtypes)
        results[name] = err
        if verbose:
            print(f"{name:32s} rows={len(sp):6d} spark={ts:5.2f}s {'OK' if err is None else 'FAIL ' + err}")
    return results


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from cohortia import get_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=8)
    res = check(spark, sf, sys.argv[2:] or None)
    bad = {k: v for k, v in res.items() if v}
    print(f"{len(res) - len(bad)}/{len(res)} ok")
