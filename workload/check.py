"""Run registered queries against their SQL checks.

``python -m workload.check [sf_dir] [query ...]``
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pyarrow as pa

from mailrisk.session import build_session


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _canonical(table: pa.Table) -> tuple[list[str], list[tuple]]:
    names = sorted(table.column_names)
    rows = zip(*(table[name].to_pylist() for name in names)) if table.num_rows else []
    return names, sorted(rows, key=repr)


def difference(spark_result: pa.Table, sql_result: pa.Table) -> str | None:
    """``None`` when names, kinds of types and all values agree."""
    names, rows = _canonical(spark_result)
    other_names, other_rows = _canonical(sql_result)
    if names != other_names:
        return f"columns {names} != {other_names}"
    types = [str(spark_result.schema.field(n).type).replace("large_", "") for n in names]
    other_types = [str(sql_result.schema.field(n).type).replace("large_", "") for n in names]
    if types != other_types:
        return f"types {dict(zip(names, types))} != {dict(zip(names, other_types))}"
    if len(rows) != len(other_rows):
        return f"{len(rows)} rows != {len(other_rows)}"
    wrong = [(a, b) for a, b in zip(rows, other_rows) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(rows)} rows differ, first {str(wrong[0])[:600]}"
    return None


def main(arguments: list[str]) -> int:
    from workload.oracles import ORACLES
    from workload.queries import QUERIES

    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "16g", "spark.ui.enabled": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(sf_dir)
    failed = 0
    for name in arguments[1:] or QUERIES:
        start = time.time()
        try:
            result = QUERIES[name](spark, sf_dir).toArrow()
            seconds = time.time() - start
            if name in ORACLES:
                start = time.time()
                expected = connection.sql(ORACLES[name]).to_arrow_table()
                problem = difference(result, expected)
                note = f"sql {time.time() - start:.1f}s"
            else:
                problem, note = None, "rows only"
        except Exception as error:  # report and go on with the next query
            problem, note, seconds, result = f"{type(error).__name__}: {str(error)[:1500]}", "", 0.0, None
        rows = result.num_rows if result is not None else 0
        print(f"{'FAIL' if problem else 'ok  '} {name:28s} {rows:8d} rows {seconds:6.2f}s {note}", flush=True)
        if problem:
            failed += 1
            print("     ", problem, flush=True)
    print(f"{failed} failed", flush=True)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
