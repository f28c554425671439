"""Comparison of a DataFrame with SQL over a DuckDB connection."""

from __future__ import annotations

from collections import Counter

from tests.compare import rows_of


def same_rows(df, con, sql: str) -> None:
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = rows_of(names, cursor.fetchall())
    assert sorted(df.columns) == sorted(names)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert Counter(got) == Counter(want)
