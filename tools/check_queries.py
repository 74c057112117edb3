"""Run registered queries against their oracle SQL and report differences.

    python tools/check_queries.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import math
import pathlib
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0)
    if hasattr(value, "tzinfo") and getattr(value, "tzinfo", None):
        return str(value.replace(tzinfo=None))
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


NAMES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT",
}


def spark_type(t: str) -> str:
    return NAMES.get(t, t.upper().replace(" ", ""))


def compare(name, df, sql, con):
    """Differences between a Spark result and its oracle, as text lines."""
    rel = con.sql(sql)
    dcols, dtypes = list(rel.columns), [str(t).replace(" ", "") for t in rel.types]
    drows = rel.fetchall()
    scols = df.columns
    srows = [tuple(r) for r in df.collect()]
    out = []
    if sorted(scols) != sorted(dcols):
        return len(srows), [f"columns {sorted(scols)} vs {sorted(dcols)}"]
    dt = dict(zip(dcols, dtypes))
    for col, typ in df.dtypes:
        if spark_type(typ) != dt[col]:
            out.append(f"type of {col}: {typ} vs {dt[col]}")
    left, right = rows_of(scols, srows), rows_of(dcols, drows)
    if left != right:
        ls, rs = set(left), set(right)
        out.append(f"rows {len(left)} vs {len(right)}; columns {sorted(scols)}")
        out += [f"  spark only {r}" for r in sorted(ls - rs)[:3]]
        out += [f"  duck only  {r}" for r in sorted(rs - ls)[:3]]
    return len(left), out


def main() -> int:
    from formloom.plans import registry
    from formloom.session import local_session

    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--module")
    args = parser.parse_args()
    registry.load()
    folder = f"/root/testdata/sf{args.sf}"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    names = args.names or list(registry.QUERIES)
    if args.module:
        import importlib

        before = set()
        mod = importlib.import_module(f"formloom.plans.{args.module}")
        names = [n for n, f in registry.QUERIES.items() if f.__closure__[0].cell_contents.__module__ == mod.__name__]
    bad = []
    for name in names:
        t0 = time.time()
        try:
            df = registry.QUERIES[name](spark, folder)
            if name in registry.ORACLES:
                n, diff = compare(name, df, registry.ORACLES[name], con)
            else:
                n, diff = df.count(), []
        except Exception as err:  # a failing query must not hide the others
            n, diff = -1, [str(err)[:1500]]
        flag = "ok  " if not diff else "FAIL"
        kind = "oracle" if name in registry.ORACLES else "rows"
        print(f"{flag} {name:32s} {kind:6s} rows={n} {time.time() - t0:.2f}s" + ("  EMPTY" if n == 0 else ""), flush=True)
        for line in diff:
            print("    " + line)
        if diff:
            bad.append(name)
    print(f"{len(names) - len(bad)} of {len(names)} agree", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
