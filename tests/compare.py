"""Compare a Spark result with a DuckDB result: columns by name, rows in any order."""

from __future__ import annotations

import glob
import os

import duckdb

DATA = os.environ.get("TEST_DATA", "/root/testdata")


def duck(folder: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    picked = [tuple(row[i] for i in order) for row in rows]
    return [names[i] for i in order], sorted(picked, key=repr)


def spark_rows(df):
    return sorted_rows(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    found = con.execute(sql)
    return sorted_rows([c[0] for c in found.description], found.fetchall())


def difference(spark_result, duck_result) -> str | None:
    (names, rows), (want_names, want_rows) = spark_result, duck_result
    if names != want_names:
        return f"columns {names} are not {want_names}"
    if len(rows) != len(want_rows):
        return f"{len(rows)} rows, expected {len(want_rows)}"
    for got, want in zip(rows, want_rows):
        if got != want:
            return f"{got!r:.600} is not {want!r:.600}"
    return None


_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
          "boolean": "BOOLEAN"}


def type_difference(df, con, sql) -> str | None:
    found = con.execute(f"DESCRIBE {sql}").fetchall()
    want = {name: kind for name, kind, *_ in found}
    got = {name: _TYPES[kind] for name, kind in df.dtypes}
    return None if got == want else f"{got} is not {want}"
