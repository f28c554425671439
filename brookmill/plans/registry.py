"""Registry of named queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from brookmill.sources.tables import Tables


def expand_round_to(sql: str) -> str:
    """Write out ``round_to(expression, digits)``, the SQL form of
    :func:`brookmill.functions.types.round_to`."""
    while (start := sql.find("round_to(")) >= 0:
        depth, comma, end = 0, -1, start + len("round_to")
        for end in range(start + len("round_to"), len(sql)):
            ch = sql[end]
            depth += (ch == "(") - (ch == ")")
            if ch == "," and depth == 1:
                comma = end
            if depth == 0:
                break
        inner, digits = sql[start + len("round_to(") : comma], int(sql[comma + 1 : end])
        value, step = f"CAST({inner} AS DOUBLE)", f"1e{digits}"
        rounded = f"sign({value}) * floor(abs({value}) * {step} + 0.500001) / {step} + 0.0"
        sql = f"{sql[:start]}(CASE WHEN abs({value}) * {step} < 4503599627370496 THEN {rounded} ELSE {value} END){sql[end + 1:]}"
    return sql


@dataclass(frozen=True)
class Query:
    """``build`` makes the DataFrame, ``sql`` is the same result for DuckDB (None: no SQL form),
    ``covers`` lists inventory ids."""

    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None
    covers: tuple[str, ...]

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(spark, folder))


QUERIES: dict[str, Query] = {}


def query(name: str, covers: str, sql: str | None = None):
    """Register a function over :class:`Tables` as a named query."""

    def add(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(name, build, expand_round_to(sql.strip()) if sql else None, tuple(covers.split()))
        return build

    return add
