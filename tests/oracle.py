"""Run named queries next to their SQL twins and compare names, types and rows.

    python -m tests.oracle [--sf DIR] [name or prefix ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
KINDS = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamp",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return 0.0 if v == 0 else v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def compare(spark: SparkSession, con, query, folder: str) -> str | None:
    """None when equal, else what differs. A query without SQL must just give rows."""
    df = query.run(spark, folder)
    names = sorted(df.columns)
    rows = [tuple(plain(v) for v in r) for r in df.select(*names).collect()]
    if query.sql is None:
        return None if rows else "no rows"
    cur = con.execute(query.sql)
    theirs_names = [d[0] for d in cur.description]
    kinds = {d[0]: str(d[1]) for d in cur.description}
    if sorted(theirs_names) != names:
        return f"columns {names} against {sorted(theirs_names)}"
    for f in df.schema.fields:
        mine = f.dataType.simpleString().replace("timestamp_ntz", "timestamp")
        if mine != KINDS.get(kinds[f.name], kinds[f.name]):
            return f"type of {f.name}: {mine} against {kinds[f.name]}"
    at = [theirs_names.index(n) for n in names]
    theirs = [tuple(plain(r[i]) for i in at) for r in cur.fetchall()]
    a, b = Counter(rows), Counter(theirs)
    if a == b:
        return None if rows else "equal, but no rows"
    gone, extra = list((b - a).elements()), list((a - b).elements())
    key = lambda r: tuple(str(x) for x in r)
    return (
        f"{len(rows)} rows against {len(theirs)}; {len(extra)} differ: "
        f"{sorted(extra, key=key)[:3]} against {sorted(gone, key=key)[:3]}"
    )


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--slow", type=float, default=3.0)
    parser.add_argument("--partitions", default="8")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from wattshed.catalogue import CATALOGUE

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", args.partitions)
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.sf)
    bad = 0
    chosen = [
        q for q in CATALOGUE.values() if not args.names or q.name.startswith(tuple(args.names))
    ]
    for q in chosen:
        start = time.time()
        try:
            problem = compare(spark, con, q, args.sf)
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        took = time.time() - start
        if problem:
            bad += 1
            print(f"FAIL {q.name}: {problem}", flush=True)
        elif took > args.slow:
            print(f"slow {q.name}: {took:.1f}s", flush=True)
    print(f"{len(chosen) - bad} of {len(chosen)} agree", flush=True)
    return bad


if __name__ == "__main__":
    raise SystemExit(main())
