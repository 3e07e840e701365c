"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python scripts/oracle_check.py [SF_DIR] [key-prefix ...]

Comparison: column names (sorted), row count, column type family, and an
order-insensitive multiset of rows. Floats compare exactly ("strict") and after
rounding to 6 decimals ("loose"); a strict mismatch is reported because an
exact value hash would see it.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from cuenca.plans.registry import load_all  # noqa: E402
from cuenca.session import get_session  # noqa: E402
from cuenca.sources.tables import TABLE_NAMES  # noqa: E402


def family_spark(t) -> str:
    n = t.simpleString()
    if n in ("tinyint", "smallint", "int", "bigint"):
        return "int:" + n
    if n in ("float", "double"):
        return "float"
    if n.startswith("decimal"):
        return "decimal"
    if n.startswith("timestamp"):
        return "timestamp"
    return n.split("(")[0].split("<")[0]


def family_duck(t: str) -> str:
    t = t.upper()
    ints = {"TINYINT": "tinyint", "SMALLINT": "smallint", "INTEGER": "int", "BIGINT": "bigint",
            "HUGEINT": "hugeint", "UINTEGER": "uint", "UBIGINT": "ubigint"}
    if t in ints:
        return "int:" + ints[t]
    if t in ("DOUBLE", "FLOAT"):
        return "float"
    if t.startswith("DECIMAL"):
        return "decimal"
    if t.startswith("TIMESTAMP"):
        return "timestamp"
    if t == "VARCHAR":
        return "string"
    if t == "BOOLEAN":
        return "boolean"
    if t == "DATE":
        return "date"
    if t.endswith("[]"):
        return "array"
    if t.startswith("STRUCT"):
        return "struct"
    return t.lower()


_SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                  "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
                  "timestamp": "TIMESTAMP WITH TIME ZONE", "smallint": "SMALLINT",
                  "tinyint": "TINYINT", "float": "FLOAT"}


def exact_spark(t) -> str:
    """Spark type written the way DuckDB names it (decimal(p,s) → DECIMAL(p,s))."""
    n = t.simpleString()
    return _SPARK_TO_DUCK.get(n, n.upper())


def norm(v, loose):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) if loose else v
    if isinstance(v, decimal.Decimal):
        return float(round(v, 6)) if loose else str(v.normalize())
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x, loose) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x, loose)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return norm(v.asDict(), loose)
    return v


def multiset(rows, idx, loose):
    out = {}
    for r in rows:
        k = tuple(norm(r[i], loose) for i in idx)
        out[k] = out.get(k, 0) + 1
    return out


def main():
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    prefixes = [a for a in args if not a.startswith("/")]
    spark = get_session("local[8]", shuffle_partitions=8,
                        extra={"spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    reg = load_all()
    keys = sorted(k for k in reg if not prefixes or any(k.startswith(p) for p in prefixes))
    ok = bad = nosql = 0
    for k in keys:
        e = reg[k]
        t0 = time.time()
        try:
            df = e.build(spark, sf)
            srows = df.collect()
            scols = df.columns
            sfam = [family_spark(f.dataType) for f in df.schema.fields]
            sexact = [exact_spark(f.dataType) for f in df.schema.fields]
        except Exception:
            bad += 1
            print(f"FAIL {k}: spark error\n{traceback.format_exc()[-1500:]}")
            continue
        ts = time.time() - t0
        if e.sql is None:
            nosql += 1
            print(f"ROWS {k}: {len(srows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            cur = con.execute(e.sql)
            drows = cur.fetchall()
            dcols = [d[0] for d in cur.description]
            dfam = [family_duck(str(d[1])) for d in cur.description]
            dexact = [str(d[1]).upper() for d in cur.description]
        except Exception as ex:
            bad += 1
            print(f"FAIL {k}: duckdb error {ex}")
            continue
        problems = []
        if sorted(scols) != sorted(dcols):
            problems.append(f"columns spark={sorted(scols)} duck={sorted(dcols)}")
        else:
            order_s = sorted(range(len(scols)), key=lambda i: scols[i])
            order_d = sorted(range(len(dcols)), key=lambda i: dcols[i])
            fs = [sfam[i] for i in order_s]
            fd = [dfam[i] for i in order_d]
            if fs != fd:
                diff = [(scols[i], a, b) for i, a, b in zip(order_s, fs, fd) if a != b]
                problems.append(f"types {diff}")
            else:
                es = [sexact[i] for i in order_s]
                ed = [dexact[i] for i in order_d]
                diff = [(scols[i], a, b) for i, a, b in zip(order_s, es, ed) if a != b]
                if diff:
                    problems.append(f"exact types {diff}")
            if len(srows) != len(drows):
                problems.append(f"rows spark={len(srows)} duck={len(drows)}")
            elif multiset(srows, order_s, False) != multiset(drows, order_d, False):
                ms, md = multiset(srows, order_s, True), multiset(drows, order_d, True)
                if ms != md:
                    only_s = [r for r in ms if ms[r] != md.get(r)][:3]
                    only_d = [r for r in md if md[r] != ms.get(r)][:3]
                    problems.append(f"values differ; spark-only {only_s} duck-only {only_d}")
                else:
                    problems.append("values differ only in float last digits (strict)")
        if problems:
            bad += 1
            print(f"FAIL {k}: " + "; ".join(problems))
        else:
            ok += 1
            print(f"OK   {k}: {len(srows)} rows {ts:.1f}s")
    print(f"SUMMARY ok={ok} fail={bad} no_oracle={nosql} total={len(keys)}")
    spark.stop()


if __name__ == "__main__":
    main()
