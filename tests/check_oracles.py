"""Compare every named query with its SQL: ``python tests/check_oracles.py [sf_dir] [name ...]``."""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb
import pandas as pd

import __spark_entry__ as entry
from streamlytics import build_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].astype(object).where(frame.notna(), None)
    return frame.map(repr_value).sort_values(list(frame.columns)).reset_index(drop=True)


def repr_value(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, float):
        return repr(int(value)) if value.is_integer() else repr(value)
    if hasattr(value, "item"):
        return repr_value(value.item())
    if hasattr(value, "isoformat"):
        return value.isoformat()[:10] if str(value).endswith("00:00:00") or len(value.isoformat()) == 10 \
            else value.isoformat()
    return str(value)


def difference(spark, con, name: str, sf_dir: str) -> str | None:
    """None when both sides agree, else what differs."""
    mine = canonical(entry.queries()[name](spark, sf_dir).toPandas())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None if len(mine) else "no rows"
    theirs = canonical(con.execute(sql).df())
    if list(mine.columns) != list(theirs.columns):
        return f"columns {list(mine.columns)} != {list(theirs.columns)}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)}"
    wrong = (mine != theirs).any(axis=1)
    if wrong.any():
        return f"{wrong.sum()} of {len(mine)} rows differ:\n{mine[wrong].head(3)}\n{theirs[wrong].head(3)}"
    return None


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = build_session("oracles", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__driver__memory="8g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names:
        began = time.time()
        try:
            problem = difference(spark, con, name, sf_dir)
        except Exception:  # noqa: BLE001 - report every query
            problem = traceback.format_exc()[-1500:]
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - began:.1f}s {problem or ''}", flush=True)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
