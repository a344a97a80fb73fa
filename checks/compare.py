"""Run queries next to their DuckDB statements and compare all rows.

    python -m checks.compare [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import math
import tempfile
import time
from pathlib import Path

import duckdb

from checks.oracles import ORACLES
from checks.queries import QUERIES
from evenhand.session import build_session

DEFAULT_SF = "/root/testdata/sf0.01"


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in Path(sf).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM read_parquet('{table}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark, connection, name: str, sf: str) -> tuple[int, str]:
    """Row count and a description of the difference, empty when there is none."""
    df = QUERIES[name](spark, sf)
    mine_columns, mine = rows_of(df.columns, df.collect())
    if name not in ORACLES:
        return len(mine), "" if mine else "no rows"
    result = connection.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    theirs_columns, theirs = rows_of(names, result.fetchall())
    if mine_columns != theirs_columns:
        return len(mine), f"columns {mine_columns} / {theirs_columns}"
    if len(mine) != len(theirs):
        return len(mine), f"rows {len(mine)} / {len(theirs)}"
    unequal = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return len(mine), f"{len(unequal)} differ, first {unequal[0]}" if unequal else ""


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--sf", default=DEFAULT_SF)
    args = parser.parse_args()
    folder = Path(tempfile.mkdtemp(prefix="evenhand-compare-")).as_uri()
    spark = build_session(
        master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.checkpoint.dir": folder}
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(args.sf)
    failed = 0
    for name in args.names or QUERIES:
        start = time.time()
        try:
            count, problem = differences(spark, connection, name, args.sf)
        except Exception as error:  # report and go on with the next query
            count, problem = -1, f"{type(error).__name__}: {str(error)[:1500]}"
        failed += bool(problem)
        kind = "sql" if name in ORACLES else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind:4} {name:32} {count:7} {time.time() - start:6.1f}s {problem}", flush=True)
    print(f"{failed} failed; without query: {sorted(set(ORACLES) - set(QUERIES))}")


if __name__ == "__main__":
    main()
