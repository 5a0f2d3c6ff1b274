"""Compare registered Spark queries with their DuckDB oracle SQL.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from credlake.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


EXACT = os.environ.get("ORACLE_EXACT") == "1"


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if EXACT else round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _duck_type(t) -> str:
    from pyspark.sql import types as T
    simple = {T.LongType: "BIGINT", T.IntegerType: "INTEGER", T.DoubleType: "DOUBLE", T.StringType: "VARCHAR",
              T.BooleanType: "BOOLEAN", T.FloatType: "FLOAT", T.ShortType: "SMALLINT", T.ByteType: "TINYINT",
              T.DateType: "DATE", T.TimestampType: "TIMESTAMP WITH TIME ZONE", T.TimestampNTZType: "TIMESTAMP"}
    for k, v in simple.items():
        if isinstance(t, k):
            return v
    if isinstance(t, T.DecimalType):
        return f"DECIMAL({t.precision},{t.scale})"
    return t.simpleString()


def _key(row):
    return tuple((x is None, str(type(x).__name__) if x is not None else "", x if x is not None else 0) for x in row)


def compare(spark, con, sf_dir: str, name: str, fn, sql: str | None, tol: float = 1e-6):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    if sql is None:
        return {"name": name, "rows": len(srows), "oracle": None, "ok": None, "sec": round(t1 - t0, 2)}
    rel = con.sql(sql)
    dcols = rel.columns
    dtypes = dict(zip(dcols, [str(t) for t in rel.types]))
    drows = rel.fetchall()
    res = {"name": name, "rows": len(srows), "oracle_rows": len(drows), "sec": round(t1 - t0, 2)}
    if sorted(scols) != sorted(dcols):
        res.update(ok=False, why=f"columns {sorted(scols)} vs {sorted(dcols)}")
        return res
    stypes = {f.name: _duck_type(f.dataType) for f in sdf.schema.fields}
    type_diff = {c: (stypes[c], dtypes[c]) for c in scols if stypes[c] != dtypes[c]}
    if type_diff:
        res["type_diff"] = type_diff
    order = sorted(scols)
    si = [scols.index(c) for c in order]
    di = [dcols.index(c) for c in order]
    S = sorted((tuple(_norm(r[i]) for i in si) for r in srows), key=_key)
    D = sorted((tuple(_norm(r[i]) for i in di) for r in drows), key=_key)
    if len(S) != len(D):
        res.update(ok=False, why="row count")
        return res
    bad = 0
    first = None
    for a, b in zip(S, D):
        for x, y in zip(a, b):
            same = x == y or (isinstance(x, (int, float)) and isinstance(y, (int, float))
                               and not isinstance(x, bool) and abs(x - y) <= tol * max(1.0, abs(x), abs(y)))
            if not same:
                bad += 1
                first = first or (a, b)
                break
    res.update(ok=bad == 0, mismatched=bad)
    if first:
        res["example"] = str(first)[:600]
    return res


def main(argv):
    from credlake.plans import ORACLES, QUERIES
    from credlake.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(QUERIES)
    if os.environ.get("PLAIN_SESSION") == "1":  # as a driver would create it
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
        import __spark_entry__
        print({"entry_rows": __spark_entry__.entry(spark).count()})
    else:
        spark = local_session()
    con = duck(sf_dir)
    failed = 0
    for n in names:
        try:
            r = compare(spark, con, sf_dir, n, QUERIES[n], ORACLES.get(n), tol=0.0 if EXACT else 1e-6)
        except Exception as e:  # report and continue
            r = {"name": n, "ok": False, "why": f"{type(e).__name__}: {str(e)[:400]}"}
        failed += r.get("ok") is False
        print(r, flush=True)
    print(f"FAILED {failed} of {len(names)}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
