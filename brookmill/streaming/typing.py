"""From messages to typed rows."""

from __future__ import annotations

from collections.abc import Iterable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brookmill.functions.dates import parse_any
from brookmill.functions.hashing import row_digest

# Field names read as dates and as times.
DATE_FIELDS = ("date", "event_date", "created_date", "updated_date")
DATETIME_FIELDS = ("timestamp", "created_at", "updated_at", "event_time")


def typed_select(
    df: DataFrame,
    date_fields: Iterable[str] = DATE_FIELDS,
    datetime_fields: Iterable[str] = DATETIME_FIELDS,
    extra: Iterable[str] = (),
) -> DataFrame:
    """Convert by field name: a date field when it is text, a time field always."""
    out = []
    for f in df.schema:
        c = F.col(f.name)
        if f.name in datetime_fields:
            kept = isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
            out.append((c.cast("timestamp") if kept else parse_any(c)).alias(f.name))
        elif f.name in date_fields and isinstance(f.dataType, T.StringType):
            out.append(parse_any(c).cast("date").alias(f.name))
        else:
            out.append(c)
    return df.select(*out, *extra)


def split_corrupt(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the texts of messages that were not valid."""
    good = decoded.filter(F.col("_corrupt").isNull()).drop("_corrupt")
    return good, decoded.filter(F.col("_corrupt").isNotNull()).select("_corrupt")


def require_few_corrupt(decoded: DataFrame, limit: int = 1000) -> DataFrame:
    """Raise when a batch holds more than ``limit`` broken messages, else the good rows."""
    good, bad = split_corrupt(decoded)
    n = bad.limit(limit + 1).count()
    if n > limit:
        raise ValueError(f"over {limit} broken messages in one batch")
    return good


def split_unparsed(df: DataFrame, source: str, parsed: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose text was read, and rows where it was present but not readable."""
    bad = F.col(source).isNotNull() & (F.trim(source) != "") & F.col(parsed).isNull()
    return df.filter(~bad), df.filter(bad)


def non_empty_dates(df: DataFrame, column: str = "date") -> DataFrame:
    return df.filter(F.coalesce(F.col(column).cast("string"), F.lit("")) != "")


def normalise(
    df: DataFrame, ts: str, numbers: list[str], others: dict[str, Any] | None = None, digest: str = "record_hash"
) -> DataFrame:
    """Drop rows without a time, default the rest, add the record digest."""
    filled = {n: F.coalesce(F.col(n), F.lit(0.0)) for n in numbers}
    filled.update({n: F.coalesce(F.col(n), F.lit(d)) for n, d in (others or {}).items()})
    kept = df.filter(F.coalesce(F.col(ts).cast("string"), F.lit("")) != "").withColumns(filled)
    return kept.withColumn(digest, row_digest(*kept.columns))


def project_streams(df: DataFrame, keys: list[str], parts: dict[str, dict[str, Column | str]]) -> dict[str, DataFrame]:
    """Split one record into several streams that share ``keys``; missing numbers become 0."""
    return {
        name: df.select(
            *keys,
            *[F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(0)).alias(out) for out, c in columns.items()],
        )
        for name, columns in parts.items()
    }
