"""Compare every registered query with its SQL twin in DuckDB.

python tools/check_oracle.py [--sf DIR] [--slice ROWS] [--only NAME,...]
``--slice`` forces the hot-key paths by cutting keys above that many rows.
"""

from __future__ import annotations

import argparse
import math
import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb
import pandas as pd

from millrace.plans import ORACLES, QUERIES
from millrace.session import get_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]

    def value(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
            return "∅"
        if isinstance(v, pd.Timestamp):
            return v.isoformat()
        if hasattr(v, "isoformat"):
            return str(v)[:10]
        if isinstance(v, float):
            return repr(v) if not v.is_integer() else str(int(v))
        return str(v)

    return sorted(tuple(value(v) for v in row) for row in frame.itertuples(index=False))


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} / {sorted(want.columns)}"
    a, b = canonical(got), canonical(want)
    if a == b:
        return None
    only_a, only_b = list(set(a) - set(b))[:2], list(set(b) - set(a))[:2]
    return f"rows {len(a)} / {len(b)}; only spark {only_a}; only sql {only_b}"


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--slice")
    parser.add_argument("--only")
    parser.add_argument("--skip-streams", action="store_true")
    parser.add_argument("--zone", default="UTC", help="session time zone")
    args = parser.parse_args()
    conf = {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    conf["spark.sql.session.timeZone"] = args.zone
    if args.slice:
        conf["millrace.rowsPerSlice"] = args.slice
    spark = get_session(master="local[8]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(args.sf), []
    names = args.only.split(",") if args.only else list(QUERIES)
    for name in names:
        if args.skip_streams and name.startswith("stream_") and name != "stream_to_table":
            continue
        began = time.time()
        try:
            got = QUERIES[name](spark, args.sf).toPandas()
            took = time.time() - began
            if name not in ORACLES:
                print(f"rows  {name} {len(got)} {took:.1f}s", flush=True)
                continue
            problem = difference(got, con.execute(ORACLES[name]).df())
            if not problem and got.empty:
                problem = "both empty"
        except Exception as error:
            took = time.time() - began
            problem = "".join(traceback.format_exception_only(error))[:900]
        if problem:
            bad.append(name)
        print(f"{'FAIL ' if problem else 'ok   '} {name} {took:.1f}s {problem or len(got)}", flush=True)
    print("failed:", bad)
    return bool(bad)


if __name__ == "__main__":
    raise SystemExit(main())
