"""Runs registered queries beside their SQL twins and compares rows and types.

usage: python tools/compare.py [folder] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from vecindad.registry.oracle import ORACLE  # noqa: E402
from vecindad.registry.queries import QUERIES  # noqa: E402
from vecindad.session import build_session  # noqa: E402

DUCKDB_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "string": "VARCHAR",
    "date": "DATE", "boolean": "BOOLEAN", "double": "DOUBLE",
}


def open_tables(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return db


def differences(frame: DataFrame, db: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if rows and types agree, else what differs."""
    twin = db.sql(sql)
    want = {c: str(t) for c, t in zip(twin.columns, twin.types, strict=True)}
    have = {
        f.name: DUCKDB_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString().upper())
        for f in frame.schema.fields
    }
    if {c: t.replace(" ", "") for c, t in want.items()} != have:
        return f"types: {sorted(have.items())} against {sorted(want.items())}"
    names = sorted(have)
    ours = Counter(map(tuple, frame.select(*names).collect()))
    theirs = Counter(twin.project(", ".join(f'"{n}"' for n in names)).fetchall())
    if ours == theirs:
        return None if ours else "no rows"
    only_ours, only_theirs = list((ours - theirs).items()), list((theirs - ours).items())
    return (
        f"rows: {sum(ours.values())} against {sum(theirs.values())};"
        f" {len(only_ours)} only here {only_ours[:2]}, {len(only_theirs)} only there"
        f" {only_theirs[:2]} in {names}"
    )


def main(folder: str, names: list[str]) -> int:
    spark: SparkSession = build_session(
        "compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in names or QUERIES:
        start = time.perf_counter()
        try:
            problem = differences(QUERIES[name](spark, folder), open_tables(folder), ORACLE[name])
        except Exception as error:  # noqa: BLE001 - reported, and the next query is run
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:32} {time.perf_counter() - start:6.1f}s  {problem or 'equal'}", flush=True)
    print(f"{failed} of {len(names or QUERIES)} differ")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001", sys.argv[2:]))
