"""Compare registered queries with their SQL in DuckDB: columns by name, rows as a bag."""
from __future__ import annotations

import datetime
import decimal
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, float):
        return ("float", repr(value))
    if isinstance(value, (datetime.datetime, datetime.date)):
        return ("time", value.isoformat())
    return (type(value).__name__, value)


def compare(spark_df, con, sql: str) -> tuple[int, int, list]:
    """(rows in Spark, rows in DuckDB, up to three differences)."""
    relation = con.execute(sql)
    names = [d[0] for d in relation.description]
    columns = sorted(names)
    if columns != sorted(spark_df.columns):
        return -1, -1, [("columns", sorted(spark_df.columns), columns)]
    order = [names.index(c) for c in columns]
    theirs = Counter(tuple(_plain(row[i]) for i in order) for row in relation.fetchall())
    mine = Counter(tuple(_plain(v) for v in row) for row in spark_df.select(*[f"`{c}`" for c in columns]).collect())
    odd = [("spark", r) for r in list((mine - theirs).elements())[:3]] + [("duckdb", r) for r in list((theirs - mine).elements())[:3]]
    return sum(mine.values()), sum(theirs.values()), odd


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from orestrata.session import build_session
    from __spark_entry__ import oracle_sql, queries

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:] or list(queries())
    spark = build_session("oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir)
    for name in wanted:
        start = time.time()
        try:
            df = queries()[name](spark, sf_dir)
            if name not in oracle_sql():
                print(f"{name}: rows only, {df.count()}")
                continue
            mine, theirs, odd = compare(df, con, oracle_sql()[name])
            print(f"{'ok  ' if not odd else 'FAIL'} {name}: {mine}/{theirs} in {time.time() - start:.1f}s", *odd, flush=True)
        except Exception as error:  # noqa: BLE001
            print(f"FAIL {name}: {type(error).__name__} {str(error)[:600]}", flush=True)
