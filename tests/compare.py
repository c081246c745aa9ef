"""Run registered queries and their SQL side by side: ``python tests/compare.py SF_DIR [name ...]``."""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb
import pyarrow as pa

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _key(value):
    if value is None:
        return (0, "")
    if isinstance(value, float) and math.isnan(value):
        return (1, "")
    if isinstance(value, bool):
        return (2, str(value))
    if isinstance(value, (int, float)):
        return (3, repr(value + 0.0 if isinstance(value, float) else value))
    if isinstance(value, dt.datetime):
        return (4, value.isoformat())
    return (5, str(value))


def _rows(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return sorted(tuple(_key(v) for v in row) for row in zip(*columns))


def _types(table: pa.Table) -> dict[str, str]:
    return {
        f.name: str(f.type).replace("large_", "").replace("[ns]", "[us]") for f in table.schema
    }


def compare(spark, con, sf_dir: str, name: str, query, sql: str) -> str | None:
    """What differs, or ``None``."""
    got = query(spark, sf_dir).toArrow()
    want = con.execute(sql).fetch_arrow_table() if hasattr(con, "fetch_arrow_table") else con.sql(sql).arrow()
    if isinstance(want, pa.RecordBatchReader):
        want = want.read_all()
    if sorted(got.column_names) != sorted(want.column_names):
        return f"columns {sorted(got.column_names)} != {sorted(want.column_names)}"
    types, wanted = _types(got), _types(want)
    if types != wanted:
        return f"types {[(k, types[k], wanted[k]) for k in types if types[k] != wanted[k]]}"
    if got.num_rows != want.num_rows:
        return f"{got.num_rows} rows != {want.num_rows}"
    a, b = _rows(got), _rows(want)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ, first: {bad[0]}"
    return None


def main(sf_dir: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from fillwatch.session import local_session

    spark = local_session("8")
    con = connect(sf_dir)
    sql = entry.oracle_sql()
    failed = 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        if name not in sql:
            print(f"{name:30s} no SQL")
            continue
        start = time.time()
        try:
            wrong = compare(spark, con, sf_dir, name, query, sql[name])
        except Exception as error:  # noqa: BLE001
            wrong = f"{type(error).__name__}: {str(error)[:700]}"
        failed += wrong is not None
        print(f"{name:30s} {'ok' if wrong is None else wrong} ({time.time() - start:.1f}s)", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
