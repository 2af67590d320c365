"""Compare registered queries with their SQL. Usage: check_queries.py [sf_dir] [name ...]"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from decimal import Decimal
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(root: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET threads=4")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{root}/{name}.parquet'")
    return con


def kind(value):
    """Value with a tag for its type family, so 1 and 1.0 do not pass for equal."""
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ("0",)
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, int):
        return ("int", value)
    if isinstance(value, float):
        return ("float", repr(value + 0.0))
    if isinstance(value, Decimal):
        return ("decimal", str(value))
    if isinstance(value, dt.datetime):
        return ("ts", value.isoformat())
    return (type(value).__name__, str(value))


def rows_of(records, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([kind(r[i]) for i in order]) for r in records)


def compare(spark_df, con, sql):
    """None when equal, else a short description of the difference."""
    names = spark_df.columns
    mine = rows_of([tuple(r) for r in spark_df.collect()], names)
    result = con.execute(sql)
    their_names = [d[0] for d in result.description]
    if sorted(names) != sorted(their_names):
        return f"columns {sorted(set(names) ^ set(their_names))}"
    theirs = rows_of(result.fetchall(), their_names)
    if mine == theirs:
        return None
    a, b = set(mine), set(theirs)
    return (
        f"rows {len(mine)} vs {len(theirs)}; only here {len(a - b)}, only sql {len(b - a)}\n"
        f"  names {sorted(names)}\n  here {sorted(a - b)[:2]}\n  sql  {sorted(b - a)[:2]}"
    )


def main(root: str, only: list[str]) -> int:
    import __spark_entry__ as entry
    from weatherloom.session import build_session
    from weatherloom.sources.sink import release_scratch

    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(root), entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            df = fn(spark, root)
            problem = compare(df, con, sql[name]) if name in sql else f"(no sql) rows {df.count()}"
        except Exception as exc:  # report every query, not only the first broken one
            problem = f"{type(exc).__name__}: {str(exc)[:600]}"
        release_scratch(spark)
        ok = problem is None or problem.startswith("(no sql)")
        bad += not ok
        print(f"{'ok  ' if ok else 'BAD '} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    args = sys.argv[1:]
    sys.exit(bool(main(args[0] if args else "/root/testdata/sf0.001", args[1:])))
