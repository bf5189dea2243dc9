"""Compare registered queries with their SQL in DuckDB.

    python -m tests.oracle_check [folder] [key ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import tempfile
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def plain(value: object) -> object:
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def sorted_rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty if equal, else what differs first."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    expected = sorted_rows(names, result.fetchall())
    got = sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(expected) != len(got):
        return f"rows {len(got)} != {len(expected)}"
    like = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date", "BOOLEAN": "boolean"}
    odd = [
        f"{n}: {t} vs {kinds[n]}" for n, t in df.dtypes if like.get(kinds[n].upper()) != t
    ]
    wrong = [(g, e) for g, e in zip(got, expected, strict=True) if repr(g) != repr(e)]
    if wrong:
        return f"{len(wrong)} values differ, e.g. {wrong[0][0]} != {wrong[0][1]}" + (f" types {odd}" if odd else "")
    return f"types {odd}" if odd else ""


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from pitval.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    known, sql = queries(), oracle_sql()
    keys = sys.argv[2:] or list(known)
    spark = build_session(
        "oracle-check", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false", spark__checkpoint__dir=tempfile.mkdtemp(prefix="oracle-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    bad = 0
    for key in keys:
        start = time.time()
        try:
            df = known[key](spark, folder)
            if key in sql:
                message = compare(df, con, sql[key])
            else:
                message = "" if df.count() > 0 else "no rows"
        except Exception as error:  # noqa: BLE001
            message = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(message)
        kind = "F" if key in sql else "R"
        print(f"{'ok  ' if not message else 'FAIL'} {kind} {key:26s} {time.time() - start:6.1f}s {message}", flush=True)
    print(f"{len(keys) - bad} of {len(keys)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(main())
