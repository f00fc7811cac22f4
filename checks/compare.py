"""Run registered queries next to their SQL and compare whole results.

    python -m checks.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
    "date": "DATE",
}


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        if isinstance(value, dt.datetime):
            return value.isoformat()
        return str(value) if isinstance(value, dt.date) else value

    return sorted((tuple(cell(row[i]) for i in order) for row in rows), key=repr)


def compare(con: duckdb.DuckDBPyConnection, name: str, result: DataFrame) -> str | None:
    """Null when columns and all rows agree, otherwise what differs."""
    answer = con.execute(ORACLES[name])
    columns = [c[0] for c in answer.description]
    if sorted(columns) != sorted(result.columns):
        return f"columns {sorted(result.columns)} are not {sorted(columns)}"
    types = {c[0]: str(c[1]) for c in answer.description}
    odd = {c: (t, types[c]) for c, t in result.dtypes if TYPES.get(t) != types[c]}
    if odd:
        return f"types differ: {odd}"
    wanted = _rows(columns, answer.fetchall())
    got = _rows(result.columns, result.collect())
    if got == wanted:
        return None if got else "both sides are empty"
    extra = [r for r in got if r not in set(wanted)][:2]
    missing = [r for r in wanted if r not in set(got)][:2]
    return f"{len(got)} rows for {len(wanted)}; extra {extra}; missing {missing}"


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(sf_dir)
    failed = 0
    for name in argv[1:] or QUERIES:
        start = time.time()
        try:
            difference = compare(con, name, QUERIES[name](spark, sf_dir))
        except Exception as error:
            difference = f"{type(error).__name__}: {error}"
        failed += difference is not None
        print(f"{name:26s} {time.time() - start:6.2f}s {difference or 'ok'}"[:1500], flush=True)
    print(f"{failed} differ")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
