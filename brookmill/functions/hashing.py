"""Hashes, shard numbers and repeatable pseudo-random values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from brookmill.functions.types import as_col


def shard_of(n: int, *cols: Column | str) -> Column:
    """Shard number 0..n-1. Only the spread matters, not the value."""
    return F.pmod(F.xxhash64(*[as_col(c) for c in cols]), F.lit(n)).cast("int")


def row_digest(*names: str) -> Column:
    """Full-width digest of a record, equal for equal name/value pairs in any column order.

    A 32-bit digest would collide at tens of thousands of rows and drop real
    records when used for removing repeats; 256 bits do not.
    """
    # Length before text, so that no two records share one spelling.
    def part(n: str) -> Column:
        v = F.col(n).cast("string")
        return F.coalesce(F.concat(F.lit(f"{n}="), F.length(v).cast("string"), F.lit(":"), v), F.lit(f"{n}:"))

    return F.sha2(F.concat_ws("|", *[part(n) for n in sorted(names)]), 256)


def repeatable_text(c: Column | str, length: int) -> Column:
    """Text of ``length`` hex characters that depends only on ``c`` (at most 32)."""
    return F.substring(F.md5(as_col(c).cast("string")), 1, length)


def repeatable_unit(salt: int, *cols: Column | str) -> Column:
    """Number in [0, 1) that depends only on the columns and ``salt``.

    ``rand`` differs when a lost task runs again on other input order; this
    does not.
    """
    h = F.xxhash64(F.lit(salt), *[as_col(c) for c in cols])
    return F.pmod(h, F.lit(1 << 52)) / F.lit(float(1 << 52))


def stable_number(*cols: Column | str) -> Column:
    """Number below 2**32 that depends only on the columns' text; other engines with MD5 give the same."""
    text = F.md5(F.concat_ws("|", *[as_col(c).cast("string") for c in cols]))
    return F.conv(F.substring(text, 1, 8), 16, 10).cast("long")


def stable_sql(*cols: str) -> str:
    """The SQL form of :func:`stable_number`."""
    return f"CAST('0x' || substr(md5(concat_ws('|', {', '.join(cols)})), 1, 8) AS BIGINT)"


def new_uuid() -> Column:
    return F.uuid()
