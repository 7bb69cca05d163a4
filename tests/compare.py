"""Run registered queries against their SQL counterparts and report differences."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb


def oracle_rows(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    found = con.execute(sql)
    return [column[0] for column in found.description], found.fetchall()


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda place: columns[place])
    return sorted(tuple(_cell(row[place]) for place in order) for row in rows)


def difference(columns, rows, oracle_columns, oracle_found) -> str | None:
    if sorted(columns) != sorted(oracle_columns):
        return f"columns {sorted(columns)} != {sorted(oracle_columns)}"
    ours, theirs = canonical(columns, rows), canonical(oracle_columns, oracle_found)
    if ours == theirs:
        return None
    left, right = [row for row in ours if row not in set(theirs)], [row for row in theirs if row not in set(ours)]
    return f"{len(ours)} rows / {len(theirs)} rows; only Spark {left[:2]}; only SQL {right[:2]}"


def compare(spark, name: str, sf_dir: str) -> str | None:
    from __spark_entry__ import oracle_sql, queries

    df = queries()[name](spark, sf_dir)
    rows = [tuple(row) for row in df.collect()]
    sql = oracle_sql().get(name)
    if sql is None:
        return None if rows else "no rows"
    return difference(df.columns, rows, *oracle_rows(sql, sf_dir))


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from __spark_entry__ import queries
    from tidewell import build_session

    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    folder = sys.argv[1]
    names = sys.argv[2:] or list(queries())
    for name in names:
        start = time.time()
        try:
            found = compare(spark, name, folder)
        except Exception as error:  # report and go on
            found = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok  ' if found is None else 'DIFF'} {name} {time.time() - start:.1f}s {found or ''}", flush=True)
