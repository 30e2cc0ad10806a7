"""Run registered queries next to their checking SQL: python tests/compare.py SF_DIR [name ...]"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def checker(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def cell(value):
    """One spelling for values both engines hold."""
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, query, sql, sf_dir):
    """Returns (rows, seconds, message); the message is empty when both agree."""
    started = time.time()
    df = query(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    seconds = time.time() - started
    if sql is None:
        return len(got), seconds, "" if got else "no rows"
    found = con.execute(sql)
    columns = [d[0] for d in found.description]
    want = found.fetchall()
    if sorted(df.columns) != sorted(columns):
        return len(got), seconds, f"columns {sorted(df.columns)} against {sorted(columns)}"
    a, b = rows_of(df.columns, got), rows_of(columns, want)
    if a == b:
        return len(got), seconds, ""
    first = next((x for x in zip(a, b) if x[0] != x[1]), None)
    return len(got), seconds, f"{len(a)} rows against {len(b)}, first difference {first}"


def main() -> int:
    import __spark_entry__ as entry
    from framecat.session import local_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.ui.explainMode", "simple")
    con, sqls, bad = checker(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        try:
            rows, seconds, message = compare(spark, con, query, sqls.get(name), sf_dir)
        except Exception as exc:  # noqa: BLE001 - told below
            rows, seconds, message = -1, 0.0, f"{type(exc).__name__}: {str(exc)[:600]}"
        bad += bool(message)
        kind = "sql" if name in sqls else "rows"
        print(f"{'ok ' if not message else 'BAD'} {name} {kind} rows={rows} {seconds:.1f}s {message}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main())
