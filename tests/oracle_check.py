"""Run registered queries beside their SQL and compare whole results.

``python tests/oracle_check.py [sf_dir] [query ...]``
"""

from __future__ import annotations

import datetime
import decimal
import sys
import tempfile
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import DataFrame  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value) if value % 1 else int(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat(" ")
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(frame: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[str, int]:
    """A message, empty if the results are equal, and the number of rows."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    expected = rows_of(names, result.fetchall())
    found = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} but SQL {sorted(names)}", len(found)
    if found != expected:
        more = [r for r in found if r not in set(expected)][:3]
        less = [r for r in expected if r not in set(found)][:3]
        return f"{len(found)} rows but SQL {len(expected)}\n  only Spark {more}\n  only SQL {less}", len(found)
    return "", len(found)


def main() -> int:
    import __spark_entry__ as registered

    from candlewick.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        **{"spark.master": "local[8]", "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.checkpoint.dir": tempfile.mkdtemp()}
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(sf_dir)
    bad = 0
    for name, run in registered.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:] or name not in registered.oracle_sql():
            continue
        start = time.time()
        try:
            message, n = compare(run(spark, sf_dir), connection, registered.oracle_sql()[name])
        except Exception as error:  # noqa: BLE001
            message, n = f"{type(error).__name__}: {str(error)[:900]}", 0
        bad += bool(message)
        print(f"{'BAD' if message else 'ok '} {name:32} {n:7} rows {time.time() - start:6.1f}s {message}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
