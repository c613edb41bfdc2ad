"""Run named queries in Spark and in DuckDB and compare their rows.

    python tests/oracle_check.py [folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (float, Decimal)):
        number = float(value)
        return "nan" if math.isnan(number) else number + 0.0
    return value if isinstance(value, int) else str(value)


def _family(name: str) -> str:
    name = name.upper()
    for family, words in {"int": ("INT", "LONG"), "float": ("DOUBLE", "FLOAT"), "text": ("STRING", "VARCHAR")}.items():
        if any(w in name for w in words) and "HUGE" not in name:
            return family
    return name


def canonical(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def differences(frame, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty when both sides agree, else what differs."""
    spark_names, spark_rows = canonical(frame.columns, frame.collect())
    result = con.execute(sql)
    names, rows = canonical([d[0] for d in result.description], result.fetchall())
    if spark_names != names:
        return f"columns {spark_names} != {names}"
    ours = {f.name: _family(f.dataType.simpleString()) for f in frame.schema.fields}
    theirs = {d[0]: _family(str(d[1])) for d in result.description}
    if ours != theirs:
        return f"types {sorted(set(ours.items()) ^ set(theirs.items()))}"
    if repr(spark_rows) == repr(rows):
        return ""
    ours, theirs = set(map(repr, spark_rows)), set(map(repr, rows))
    return (
        f"{len(spark_rows)} rows, expected {len(rows)}; only ours {sorted(ours - theirs)[:2]}; "
        f"only theirs {sorted(theirs - ours)[:2]}"
    )


def main() -> int:
    import __spark_entry__ as entry
    from clickloom.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle, failed = connect(folder), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            found = differences(query(spark, folder), con, oracle[name]) if name in oracle else ""
        except Exception as error:  # report and go on with the next query
            found = f"error {str(error)[:600]}"
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok':4s} {name} {time.time() - start:.1f}s {found}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
