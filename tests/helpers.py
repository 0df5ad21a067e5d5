"""Comparison of a Spark result with DuckDB's on the same tables."""

from __future__ import annotations

import datetime
import decimal
from collections import Counter
from pathlib import Path

import duckdb

SF = "/root/testdata/sf0.001"


def plain(x):
    if isinstance(x, decimal.Decimal):
        x = float(x)
    if isinstance(x, float):
        return None if x != x else float(f"{x:.9g}") if abs(x) > 1e-9 else 0.0
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None).isoformat()
    if isinstance(x, (list, tuple)):
        return tuple(plain(y) for y in x)
    if isinstance(x, dict):
        return tuple((k, plain(v)) for k, v in x.items())
    return x


def bag(table) -> tuple[list[str], Counter]:
    """Columns in the order of their names, and rows as a bag."""
    names = sorted(table.column_names)
    columns = [table[c].to_pylist() for c in names]
    return names, Counter(tuple(plain(v) for v in row) for row in zip(*columns, strict=True))


def duck(sql: str, sf_dir: str = SF):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    return con.execute(sql).to_arrow_table()


def assert_same(df, sql: str, sf_dir: str = SF) -> None:
    (names, got), (named, want) = bag(df.toArrow()), bag(duck(sql, sf_dir))
    assert names == named
    assert got == want, (sum(got.values()), sum(want.values()), list((got - want).items())[:3], list((want - got).items())[:3])
