"""Run a registered query in Spark and its SQL in DuckDB, and compare the rows."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(repr(round(value, 9)))
    return value


def bag(rows, order) -> Counter:
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def differences(spark, con, name, query, sql, sf_dir) -> list[str]:
    frame = query(spark, sf_dir)
    got = frame.collect()
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = result.fetchall()
    if sorted(names) != sorted(frame.columns):
        return [f"{name}: columns {sorted(frame.columns)} against {sorted(names)}"]
    types = {name: TYPES.get(kind, kind) for name, kind in frame.dtypes}
    wrong = [(d[0], types[d[0]], str(d[1])) for d in result.description if types[d[0]] != str(d[1])]
    if wrong:
        return [f"{name}: types {wrong}"]
    ours = bag(got, [frame.columns.index(c) for c in sorted(names)])
    theirs = bag(want, [names.index(c) for c in sorted(names)])
    found = []
    if ours != theirs:
        found.append(f"{name}: {len(got)} against {len(want)} rows, columns {sorted(names)}")
        found += [f"  spark  {row}" for row in list((ours - theirs))[:5]]
        found += [f"  duckdb {row}" for row in list((theirs - ours))[:5]]
    return found
