"""Run each registered query on Spark and its oracle SQL on DuckDB; compare.

usage: python tools/check_oracle.py [sf_dir] [name ...]
Compares column names, row counts, coarse types and order-insensitive values.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from trustgrid.plans.catalog import REGISTRY  # noqa: E402
from trustgrid.session import get_session  # noqa: E402
from trustgrid.sources.tables import TABLES, table_path  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if hasattr(v, "item"):
        return norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


EXACT = {"int": "int", "integer": "int", "bigint": "bigint", "long": "bigint", "double": "double",
         "string": "str", "varchar": "str", "boolean": "bool", "float": "float", "smallint": "smallint",
         "tinyint": "tinyint", "hugeint": "hugeint", "timestamp": "timestamp", "date": "date"}


def kind(t: str) -> str:
    t = t.lower()
    if t in EXACT:
        return EXACT[t]
    if any(x in t for x in ("int", "long", "short", "byte")):
        return "int"
    if any(x in t for x in ("double", "float", "decimal")):
        return "float"
    if "bool" in t:
        return "bool"
    if any(x in t for x in ("string", "varchar", "str")):
        return "str"
    return t


def compare(spark, con, qy, sf_dir):
    """Problems (empty when equal) and the Spark row count for one query."""
    sdf = qy.build(spark, sf_dir)
    srows = [tuple(norm(x) for x in r) for r in sdf.collect()]
    scols = sdf.columns
    stypes = [kind(f.dataType.simpleString()) for f in sdf.schema.fields]
    if qy.oracle is None:
        return [], len(srows)
    rel = con.execute(qy.oracle)
    ocols = [d[0] for d in rel.description]
    otypes = [kind(str(d[1])) for d in rel.description]
    orows = [tuple(norm(x) for x in r) for r in rel.fetchall()]
    problems = []
    if sorted(scols) != sorted(ocols):
        problems.append(f"columns spark-only={sorted(set(scols)-set(ocols))} oracle-only={sorted(set(ocols)-set(scols))}")
        return problems, len(srows)
    st, ot = dict(zip(scols, stypes)), dict(zip(ocols, otypes))
    tdiff = {c: (st[c], ot[c]) for c in scols if st[c] != ot[c]}
    if tdiff:
        problems.append(f"types {tdiff}")
    order = sorted(scols)
    si = [scols.index(c) for c in order]
    oi = [ocols.index(c) for c in order]
    sset = sorted((tuple(r[i] for i in si) for r in srows), key=repr)
    oset = sorted((tuple(r[i] for i in oi) for r in orows), key=repr)
    if len(sset) != len(oset):
        problems.append(f"rows spark={len(sset)} oracle={len(oset)}")
    if sset != oset:
        diff_s = [r for r in sset if r not in oset][:3]
        diff_o = [r for r in oset if r not in sset][:3]
        problems.append(f"values differ; cols={order}\n   spark-only {diff_s}\n   oracle-only {diff_o}")
    return problems, len(srows)


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    names = [a for a in args if a in REGISTRY] or list(REGISTRY)
    spark = get_session()
    con = duck(sf_dir)
    bad = 0
    for name in names:
        t0 = time.time()
        try:
            problems, n = compare(spark, con, REGISTRY[name], sf_dir)
        except Exception as e:  # noqa: BLE001
            problems, n = [f"error {str(e)[:600]}"], 0
        if problems:
            bad += 1
            print(f"FAIL {name}: " + "; ".join(problems))
        else:
            print(f"OK   {name}: {n} rows {time.time() - t0:.1f}s")
    print(f"{len(names) - bad}/{len(names)} ok")


if __name__ == "__main__":
    main()
