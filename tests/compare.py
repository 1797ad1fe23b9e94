"""Run catalogue queries beside their SQL in DuckDB.

    python tests/compare.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def difference(df, con, sql: str) -> str | None:
    """None when both give the same columns, types of value and rows."""
    result = con.sql(sql)
    if sorted(df.columns) != sorted(result.columns):
        return f"columns {sorted(df.columns)} against {sorted(result.columns)}"
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    theirs = rows_of(result.columns, result.fetchall())
    if ours == theirs:
        return None if sum(ours.values()) else "no rows"
    only = list((ours - theirs).items())[:2], list((theirs - ours).items())[:2]
    return f"{sum(ours.values())} against {sum(theirs.values())} rows; only ours {only[0]}; only SQL {only[1]}"


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from feedweave.session import build_session

    folder, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "6g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(folder), oracle_sql(), 0
    for name, run in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            verdict = difference(df, con, sqls[name]) if name in sqls else f"rows only: {df.count()}"
        except Exception as error:
            verdict = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        ok = verdict is None or verdict.startswith("rows only")
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:28s} {time.time() - start:6.1f}s {verdict or ''}", flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(main())
