"""Compare registered queries with their SQL on DuckDB: columns, types, rows, values."""

from __future__ import annotations

import datetime
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def bag(rows, order):
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def compare(df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    rows = [tuple(r) for r in df.collect()]
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = [str(d[1]) for d in result.description]
    expected = result.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    spark_types = {n: TYPES.get(t, t) for n, t in df.dtypes}
    differing = {n: (spark_types[n], k) for n, k in zip(names, kinds) if spark_types[n] != k}
    if differing:
        return f"types {differing}"
    order = sorted(names)
    ours = bag(rows, [df.columns.index(n) for n in order])
    theirs = bag(expected, [names.index(n) for n in order])
    if ours != theirs:
        only_ours, only_theirs = list((ours - theirs).items())[:3], list((theirs - ours).items())[:3]
        return f"{len(rows)} rows against {len(expected)}; {order}; only ours {only_ours}; only SQL {only_theirs}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from tidemark.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = local_session(8, **{"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(sf_dir), 0
    for name, fn in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            sql = entry.oracle_sql().get(name)
            problem = compare(df, con, sql) if sql else f"no SQL; {df.count()} rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main())
