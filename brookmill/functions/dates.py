"""Calendar parts, time buckets, prunable ranges and lenient parsing."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from brookmill.functions.types import as_col

# Accepted spellings of a date or time besides the ISO form
# (yyyy-MM-dd, optional time after a blank or "T", any fraction, any offset).
PLAIN_FORMATS = ("yyyyMMddHHmmss", "yyyyMMdd", "d MMM yyyy", "MMM d, yyyy")
DAY_FIRST_FORMATS = ("dd/MM/yyyy HH:mm:ss", "dd/MM/yyyy", "dd.MM.yyyy")
MONTH_FIRST_FORMATS = ("MM/dd/yyyy HH:mm:ss", "MM/dd/yyyy")


def yyyymm(c: Column | str) -> Column:
    """Year and month as one integer, 202501."""
    c = as_col(c)
    return F.year(c) * 100 + F.month(c)


def yyyymmdd(c: Column | str) -> Column:
    """Year, month and day as one integer, 20250131."""
    c = as_col(c)
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def start_of(unit: str, c: Column | str) -> Column:
    """Start of the minute, hour or day as a timestamp without zone."""
    return F.date_trunc(unit, as_col(c)).cast("timestamp_ntz")


def start_of_month(c: Column | str) -> Column:
    """First day of the month as a date."""
    return F.trunc(as_col(c), "month")


def epoch_bucket(c: Column | str, seconds: int) -> Column:
    """Start of the ``seconds``-wide bucket, as seconds since 1970."""
    epoch = F.unix_timestamp(as_col(c).cast("timestamp"))
    return epoch - F.pmod(epoch, F.lit(seconds).cast("long"))


def in_range(c: Column | str, start: dt.date | dt.datetime, end: dt.date | dt.datetime) -> Column:
    """Half-open range test; unlike a test on ``year(c)`` it reaches the scan."""
    c = as_col(c)
    return (c >= F.lit(start)) & (c < F.lit(end))


def in_year(c: Column | str, year: int) -> Column:
    return in_range(c, dt.date(year, 1, 1), dt.date(year + 1, 1, 1))


def in_month(c: Column | str, month: int) -> Column:
    """``month`` is written 202501."""
    y, m = divmod(month, 100)
    return in_range(c, dt.date(y, m, 1), dt.date(y + m // 12, m % 12 + 1, 1))


def since(c: Column | str, as_of: dt.datetime | Column | None = None, **interval: int) -> Column:
    """``c >= as_of - interval``; ``interval`` as in ``days=7`` or ``hours=24``.

    ``as_of`` defaults to the current time. A fixed datetime is subtracted on
    the driver, so the scan sees a plain literal.
    """
    c = as_col(c)
    if isinstance(as_of, dt.datetime):
        return c >= F.lit(as_of - dt.timedelta(**interval))
    now = F.current_timestamp() if as_of is None else as_of
    return c >= now - F.make_interval(**{k: F.lit(v) for k, v in interval.items()})


def parse_any(c: Column | str, formats: tuple[str, ...] = PLAIN_FORMATS + DAY_FIRST_FORMATS) -> Column:
    """ISO, else the first format that fits, else NULL. Ten digits are epoch seconds.

    A caller that must not lose rows keeps the source text next to the result
    and sends rows where only the result is NULL to a side table
    (:func:`brookmill.streaming.typing.split_unparsed`).
    """
    text = F.trim(as_col(c).cast("string"))
    iso = F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}"), text.try_cast("timestamp"))
    tries = [F.try_to_timestamp(text, F.lit(f)) for f in formats]
    epoch = F.when(text.rlike(r"^\d{10}$"), F.timestamp_seconds(text.try_cast("long")))
    return F.coalesce(iso, epoch, *tries)


def parse_month_first_or_zero(c: Column | str) -> Column:
    """Month-first reading of ``a/b/yyyy``; text that fits no format becomes 1970-01-01."""
    parsed = parse_any(c, PLAIN_FORMATS + MONTH_FIRST_FORMATS + DAY_FIRST_FORMATS)
    return F.coalesce(parsed, F.timestamp_seconds(F.lit(0)))


def is_weekend(c: Column | str) -> Column:
    """Saturday or Sunday (Monday counts as 0)."""
    return F.weekday(as_col(c)) >= 5
