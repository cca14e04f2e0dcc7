"""Run queries and their SQL on the same files and compare the rows.

    python tests/side_by_side.py [folder] [query ...]
"""

from __future__ import annotations

import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def differences(df, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between a Spark result and the SQL's: columns, types, rows."""
    ours = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    theirs = {r[0]: r[1] for r in connection.execute(f"DESCRIBE {sql}").fetchall()}
    if ours != theirs:
        return [f"schema {sorted(set(ours.items()) ^ set(theirs.items()))}"]
    names = sorted(ours)
    key = lambda row: tuple((v is None, str(v)) for v in row)
    left = sorted((tuple(row) for row in df.select(*names).collect()), key=key)
    chosen = ", ".join(f'"{n}"' for n in names)
    right = sorted(connection.execute(f"SELECT {chosen} FROM ({sql})").fetchall(), key=key)
    if len(left) != len(right):
        return [f"rows {len(left)} != {len(right)}"]
    return [f"{a} != {b}" for a, b in zip(left, right) if a != b][:3]


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from stallkeep.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = build_session(
        "side-by-side", f"local[{os.cpu_count()}]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    checks = oracle_sql()
    bad = 0
    for name, run in queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            found = differences(run(spark, folder), connection, checks[name]) if name in checks else [
                f"no SQL, {run(spark, folder).count()} rows"
            ]
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:900]}"]
        bad += bool(found)
        print(f"{'ok  ' if not found else 'DIFF'} {name} {time.time() - start:.1f}s {found or ''}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
