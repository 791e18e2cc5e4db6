"""Run registered queries beside their SQL and compare rows: check_queries.py [folder] [name prefix ...]."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from claimloom.registry import ORACLE, QUERIES, loaded  # noqa: E402
from claimloom.session import build_session  # noqa: E402


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(repr(row[i]) for i in order) for row in rows))


def compare(spark, connection, folder: str, name: str) -> tuple[bool, str]:
    df = QUERIES[name](spark, folder)
    got = rows_of(df.columns, df.collect())
    if name not in ORACLE:
        return True, f"{len(got)} rows, no SQL"
    result = connection.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    want = rows_of(columns, result.fetchall())
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {df.columns} != {columns}"
    if got == want:
        return True, f"{len(got)} rows"
    extra, missing = sorted(set(got) - set(want))[:3], sorted(set(want) - set(got))[:3]
    return False, f"{len(got)} rows != {len(want)} rows\n  only spark: {extra}\n  only sql:   {missing}"


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    prefixes = tuple(sys.argv[2:])
    spark = build_session(
        "check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
                                "spark.ui.showConsoleProgress": "false", "spark.log.level": "ERROR"}
    )
    connection = connect(folder)
    started = time.time()
    loaded(spark, folder)
    print(f"load {time.time() - started:.1f}s", flush=True)
    failures = 0
    for name in QUERIES:
        if prefixes and not name.startswith(prefixes):
            continue
        started = time.time()
        try:
            good, note = compare(spark, connection, folder, name)
        except Exception as error:  # noqa: BLE001 - reported per query
            good, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        failures += not good
        print(f"{'ok  ' if good else 'FAIL'} {name} {time.time() - started:.2f}s {note}", flush=True)
    print(f"{failures} failures")
    return failures


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
