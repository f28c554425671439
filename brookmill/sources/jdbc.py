"""Tables of an external database.

``reader`` and ``writer`` take the place of ``spark.read.jdbc`` and
``df.write.jdbc``; tests inject their own, production passes none.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    split: tuple[str, int, int, int] | None = None,
    predicates: list[str] | None = None,
    reader: Callable[..., DataFrame] | None = None,
) -> DataFrame:
    """Read a table or ``(select ...) alias``. Filters and columns are pushed to the database.

    ``split`` is (numeric column, smallest, largest, parts): without it, or
    ``predicates``, one task reads everything.
    """
    args: dict[str, Any] = {"url": url, "table": table, "properties": properties or {}}
    if split:
        column, low, high, parts = split
        args.update(column=column, lowerBound=low, upperBound=high, numPartitions=parts)
    elif predicates:
        args["predicates"] = predicates
    return (reader or spark.read.jdbc)(**args)


class Database:
    """All tables of one external database by name."""

    def __init__(self, spark: SparkSession, url: str, properties: dict[str, str] | None = None, reader=None):
        self._make = lambda table, **kw: read_jdbc(spark, url, table, properties, reader=reader, **kw)

    def table(self, name: str, **kw: Any) -> DataFrame:
        return self._make(name, **kw)


def append_jdbc(
    df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None, writer: Callable[..., None] | None = None
) -> None:
    """Add rows. Rows can only be added: see :func:`change_jdbc`.

    Every task opens a connection; ``numPartitions`` in ``properties`` bounds them.
    """
    (writer or df.write.jdbc)(url=url, table=table, mode="append", properties=properties or {})


def change_jdbc(*_: Any, **__: Any) -> None:
    raise NotImplementedError("rows of an external table cannot be updated or deleted from here")
