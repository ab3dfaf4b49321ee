"""Compare registered queries with their SQL on DuckDB: rows as multisets, columns by name."""

from __future__ import annotations

import os
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(repr(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, run, sql: str | None, sf_dir: str) -> str:
    df = run(spark, sf_dir)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return f"rows only: {sum(got.values())}"
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    want = _rows(names, rel.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"FAIL columns {sorted(df.columns)} != {sorted(names)}"
    if got != want:
        return (
            f"FAIL {sum(got.values())} rows against {sum(want.values())}; columns {sorted(names)}\n"
            f"   only spark: {list((got - want).items())[:3]}\n   only duckdb: {list((want - got).items())[:3]}"
        )
    return f"ok {sum(got.values())}" if got else "EMPTY"


def session():
    from feedloom.session import build_session

    spark = build_session(
        "feedloom-tests", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="8g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    # ORACLE_CONF="name=value;name=value" tries the queries under other settings, such as no broadcasts.
    for pair in filter(None, os.environ.get("ORACLE_CONF", "").split(";")):
        spark.conf.set(*pair.split("=", 1))
    return spark


if __name__ == "__main__":
    import traceback

    from feedloom.plans import load_all

    sf = sys.argv[1]
    spark, con = session(), connect(sf)
    wanted = sys.argv[2:]
    for q in load_all().values():
        if wanted and not any(w == q.name or w == q.run.__module__.rsplit(".", 1)[1] for w in wanted):
            continue
        at = time.time()
        try:
            out = compare(spark, con, q.name, q.run, q.sql, sf)
        except Exception as e:  # noqa: BLE001
            out = "ERROR " + "\n".join(str(e).splitlines()[:6]) + "\n" + "".join(traceback.format_tb(e.__traceback__)[-2:])
        print(f"{q.name}: {out} ({time.time() - at:.1f}s)", flush=True)
