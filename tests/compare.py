"""Run registered queries beside their SQL and compare the results."""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else (int(value) if value == int(value) and abs(value) < 1e15 else value)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple((k, plain(v)) for k, v in value.items())
    if hasattr(value, "asDict"):
        return tuple((k, plain(v)) for k, v in value.asDict().items())
    if isinstance(value, bytearray):
        return bytes(value)
    return value


def table(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, run, sql: str, folder: str) -> str | None:
    """None where both agree, else what differs."""
    df = run(spark, folder)
    mine = table(df.columns, df.collect())
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    theirs = table(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} / {len(theirs)}"
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return f"{len(wrong)} of {len(mine)} rows differ, e.g. {wrong[0][0]} / {wrong[0][1]}" if wrong else None


def main() -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from reelgrain.session import build_session

    folder = sys.argv[1]
    only = sys.argv[2:]
    spark = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = connect(folder), entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if only and not any(name.startswith(o) for o in only):
            continue
        begin = time.time()
        try:
            if name in oracles:
                note = compare(spark, con, run, oracles[name], folder)
            else:
                note = f"rows only: {run(spark, folder).count()}"
        except Exception as error:  # noqa: BLE001 - every query is reported
            note = f"{type(error).__name__}: {str(error)[:600]}"
        failed = bool(note) and not note.startswith("rows only")
        bad += failed
        print(f"{'FAIL' if failed else 'ok  '} {name} {time.time() - begin:.1f}s {note or ''}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
