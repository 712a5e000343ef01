"""Compare a registered query with its SQL, or run one: python tests/oracle.py SF NAME..."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
DATA = os.environ.get("WEFT_DATA", "/root/testdata")


def duck(sql: str, sf: str) -> pd.DataFrame:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in os.listdir(f"{DATA}/{sf}"):
        path = f"{DATA}/{sf}/{name}"
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con.execute(sql).df()


def canonical(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    rows = [tuple(None if x is None or x != x else (float(f"{x:.9g}") if isinstance(x, float) else x) for x in r) for r in frame.itertuples(index=False)]
    return sorted(rows, key=repr)


def differences(spark, name: str, sf: str) -> str:
    """Empty if query and SQL agree."""
    import __spark_entry__ as entry

    ours = entry.queries()[name](spark, f"{DATA}/{sf}").toPandas()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return ""
    theirs = duck(sql, sf)
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"{name}: columns {sorted(ours.columns)} and {sorted(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"{name}: {len(ours)} and {len(theirs)} rows"
    kinds = [(c, ours[c].dtype, theirs[c].dtype) for c in ours.columns if str(ours[c].dtype) != str(theirs[c].dtype) and "object" not in (str(ours[c].dtype), str(theirs[c].dtype))]
    if kinds:
        return f"{name}: kinds {kinds}"
    a, b = canonical(ours), canonical(theirs)
    bad = [(x, y) for x, y in zip(a, b, strict=True) if repr(x) != repr(y) and x != y]
    return f"{name}: {len(bad)} rows differ, first {bad[:3]}" if bad else ""


if __name__ == "__main__":
    from weft.session import session

    spark = session(master="local[8]", **{"spark__sql__shuffle__partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    import __spark_entry__ as entry

    wanted = sys.argv[2:] or list(entry.queries())
    if len(sys.argv) == 3 and sys.argv[2].startswith("@"):
        wanted = [k for k, f in entry.queries().items() if f.__module__.endswith(sys.argv[2][1:])]
    for name in wanted:
        t = time.time()
        try:
            print(name, differences(spark, name, sys.argv[1]) or "ok", f"{time.time() - t:.1f}s", "" if name in entry.oracle_sql() else "(no SQL)", flush=True)
        except Exception as e:  # noqa: BLE001
            print(name, "ERROR", str(e)[:1500], flush=True)
