"""Run queries and their SQL on the same tables and compare the rows.

    python tests/compare.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET threads = 4")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if value is None:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def spark_bag(df):
    return bag(df.columns, [tuple(r) for r in df.collect()])


def sql_bag(con, sql):
    result = con.execute(sql)
    return bag([c[0] for c in result.description], result.fetchall())


def difference(got, want) -> str:
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if got[1] != want[1]:
        extra, lacking = got[1] - want[1], want[1] - got[1]
        shown = [str(r)[:300] for r in list(extra)[:3]], [str(r)[:300] for r in list(lacking)[:3]]
        return f"rows {sum(got[1].values())} / {sum(want[1].values())}, extra {sum(extra.values())} {shown[0]} lacking {shown[1]}"
    return ""


def main(args):
    sf_dir = "/root/testdata/sf0.01"
    if "--sf" in args:
        at = args.index("--sf")
        sf_dir = args[at + 1]
        del args[at : at + 2]
    from __spark_entry__ import ALL_QUERIES as QUERIES
    from __spark_entry__ import ALL_SQL as EXPECTED
    from chatsieve.session import build_session

    spark, con = build_session("8"), connect(sf_dir)
    bad = 0
    for name in args or QUERIES:
        start = time.time()
        try:
            got = spark_bag(QUERIES[name](spark, sf_dir))
        except Exception as error:
            bad += 1
            print(f"{name}: FAILED {str(error)[:600]}", flush=True)
            continue
        middle = time.time()
        note = "rows only"
        if name in EXPECTED:
            try:
                note = difference(got, sql_bag(con, EXPECTED[name])) or "equal"
            except Exception as error:
                note = f"SQL FAILED {str(error)[:500]}"
            bad += note != "equal"
        n = sum(got[1].values())
        print(f"{name}: {n} rows, {middle - start:.1f}s, sql {time.time() - middle:.1f}s, {note}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
