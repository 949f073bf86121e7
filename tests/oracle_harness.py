"""Run ``queries()[name]`` on Spark and ``oracle_sql()[name]`` on DuckDB and
compare row count, column types and order-insensitive values.

Usage: python tests/oracle_harness.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "smallint": "SMALLINT",
    "float": "FLOAT", "tinyint": "TINYINT",
}


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return str([_norm(x) for x in v])
    return repr(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, con, name, builder, sql, sf_dir):
    t0 = time.time()
    sdf = builder(spark, sf_dir)
    s_types = [(f.name, SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())) for f in sdf.schema.fields]
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    plan = sdf._jdf.queryExecution().executedPlan().toString()
    rel = con.sql(sql)
    d_types = [(c, str(t)) for c, t in zip(rel.columns, rel.types)]
    d_rows = rel.fetchall()
    res = {"name": name, "spark_rows": len(s_rows), "duck_rows": len(d_rows), "spark_sec": round(t1 - t0, 2),
           "cross_join": any(w in plan for w in ("CartesianProduct", "BroadcastNestedLoopJoin"))}
    res["schema_ok"] = sorted(s_types) == sorted(d_types)
    if not res["schema_ok"]:
        res["spark_schema"] = sorted(s_types)
        res["duck_schema"] = sorted(d_types)
    a = rows_of([c for c, _ in s_types], s_rows)
    b = rows_of([c for c, _ in d_types], d_rows)
    res["values_ok"] = a == b
    if not res["values_ok"]:
        diff_a = [r for r in a if r not in set(b)][:3]
        diff_b = [r for r in b if r not in set(a)][:3]
        res["only_spark"] = diff_a
        res["only_duck"] = diff_b
        res["cols"] = sorted(c for c, _ in s_types)
    return res


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from cohortlens.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = local_session()
    qs, sqls = queries(), oracle_sql()
    con = duck_connection(sf_dir)
    bad = 0
    for name in names or list(qs):
        if name not in sqls:
            sdf = qs[name](spark, sf_dir)
            print({"name": name, "rows_only": sdf.count()})
            continue
        try:
            res = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        except Exception as exc:  # report and continue
            res = {"name": name, "error": f"{type(exc).__name__}: {str(exc)[:800]}"}
        ok = res.get("schema_ok") and res.get("values_ok") and res["spark_rows"] == res["duck_rows"]
        bad += not ok
        print(("OK   " if ok else "FAIL ") + str(res), flush=True)
    print(f"failed: {bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
