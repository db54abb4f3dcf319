"""Runs registered queries on Spark and DuckDB and compares the rows.

As a script: ``python -m tests.oracle [sf_dir] [query ...]``.
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

from __spark_entry__ import oracle_sql, queries

SF_DIR = "/root/testdata/sf0.01"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def difference(spark, connection, name: str, sf_dir: str) -> str | None:
    """None when both engines agree, otherwise what differs."""
    df = queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    ours = Counter(tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    relation = connection.sql(oracle_sql()[name])
    if sorted(relation.columns) != columns:
        return f"columns {columns} against {sorted(relation.columns)}"
    listed = ", ".join(f'"{c}"' for c in columns)
    theirs = Counter(relation.project(listed).fetchall())
    if ours == theirs:
        return None if ours else "no rows"
    return (f"{sum(ours.values())} rows against {sum(theirs.values())}; "
            f"only ours {list((ours - theirs).items())[:2]}; "
            f"only theirs {list((theirs - ours).items())[:2]}")


def main() -> int:
    from tidemark.session import build_session
    given = sys.argv[1:]
    sf_dir = given.pop(0) if given and "/" in given[0] else SF_DIR
    spark = build_session("oracle", "local[8]", 8, {"spark.ui.enabled": "false",
                                                    "spark.ui.showConsoleProgress": "false",
                                                    "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failed = 0
    for name in given or queries():
        begun = time.time()
        try:
            problem = difference(spark, connection, name, sf_dir)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - begun:.2f}s "
              f"{problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
