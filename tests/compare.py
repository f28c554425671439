"""Compare named queries with their SQL twins.

As a script: ``python -m tests.compare FOLDER [NAME ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

from brookmill.sources.tables import NAMES


def connect(folder: str):
    con = duckdb.connect()
    for name in NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(v):
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, (list, tuple)):
        return tuple(_cell(x) for x in v)
    return v


def rows_of(columns, rows):
    """Rows with cells in the order of the sorted column names."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [tuple(_cell(r[i]) for i in order) for r in rows]


def difference(spark, con, query, folder: str) -> str | None:
    """None when both sides agree, else what differs."""
    df = query.run(spark, folder)
    got = df.collect()
    cur = con.execute(query.sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    a, b = rows_of(df.columns, got), rows_of(names, want)
    kinds_a = [{type(x).__name__ for x in col} - {"NoneType"} for col in zip(*a)] if a else []
    kinds_b = [{type(x).__name__ for x in col} - {"NoneType"} for col in zip(*b)] if b else []
    if a and b and kinds_a != kinds_b:
        bad = [(n, x, y) for n, x, y in zip(sorted(names), kinds_a, kinds_b) if x != y]
        return f"types {bad}"
    if len(a) != len(b):
        return f"{len(a)} rows against {len(b)}"
    only_a, only_b = Counter(a) - Counter(b), Counter(b) - Counter(a)
    if only_a or only_b:
        return f"{sum(only_a.values())} rows differ, {list(only_a)[:2]} against {list(only_b)[:2]}"
    return None if a else "no rows on either side"


def main(folder: str, names: list[str]) -> int:
    from brookmill.plans import load_all
    from brookmill.session import build_session

    spark = build_session("local[8]", "compare", 8, {"spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name, q in load_all().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if q.sql:
                bad = difference(spark, con, q, folder)
            else:
                n = q.run(spark, folder).count()
                bad = None if n else "no rows"
        except Exception as e:  # noqa: BLE001 - the report goes on with the next query
            bad = f"{type(e).__name__}: {str(e)[:600]}"
        failed += bool(bad)
        print(f"{'FAIL' if bad else 'ok  '} {time.time() - start:6.2f}s {name}{'' if q.sql else ' (rows only)'} {bad or ''}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
