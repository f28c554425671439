"""Column coercion, defaults and arithmetic that never raises."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: From here on every double is a whole number.
_WHOLE = float(2**52)


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(a: Column | str, b: Column | str) -> Column:
    """Floating division; a zero divisor gives NULL."""
    return F.try_divide(as_col(a).cast("double"), as_col(b).cast("double"))


def round_to(c: Column | str, digits: int = 0) -> Column:
    """Round half away from zero on the scaled binary value.

    Anything within a millionth of a step below a tie counts as a tie, so sums
    that were added up in another order still round the same way. NaN,
    infinities and values too large to hold a fraction at this scale come back
    as they are.
    """
    step = float(10**digits)
    value = as_col(c).cast("double")
    size = F.abs(value) * step
    rounded = F.signum(value) * F.floor(size + 0.500001) / step + 0.0
    return F.when(size < _WHOLE, rounded).otherwise(value)


def hundredths(c: Column | str) -> Column:
    """A two-decimal amount as a whole number: sums of it are exact in any order."""
    return F.rint(as_col(c) * 100).cast("long")


def int_div(a: Column | str, b: Column | str) -> Column:
    """Whole-number division towards zero, exact over 64 bits; a zero divisor gives NULL."""
    a, b = as_col(a).cast("long"), as_col(b).cast("long")
    return F.when(b != 0, F.call_function("div", a, b))


def or_default(c: Column | str, default: Any) -> Column:
    return F.coalesce(as_col(c), F.lit(default))


def with_defaults(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    """Replace NULL by a per-column default; other columns pass through."""
    return df.select(
        *[
            or_default(F.col(c), defaults[c]).cast(df.schema[c].dataType).alias(c) if c in defaults else F.col(c)
            for c in df.columns
        ]
    )


def nan_to(c: Column | str, value: float) -> Column:
    """NaN and NULL both become ``value``."""
    c = as_col(c)
    return F.when(c.isNull() | F.isnan(c), F.lit(value)).otherwise(c)


def enum_code(c: Column | str, labels: Mapping[str, int]) -> Column:
    """Integer code of a label; NULL for an unknown label."""
    pairs = [F.lit(x) for kv in labels.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), as_col(c))


def enum_is(c: Column | str, code: int, labels: Mapping[str, int]) -> Column:
    """Test a label column against an integer code; resolves to the label so it reaches the scan."""
    names = [k for k, v in labels.items() if v == code]
    return as_col(c).isin(names)


def at(c: Column, position: int | Column) -> Column:
    """1-based array access; NULL outside the array."""
    pos = F.lit(position) if isinstance(position, int) else position
    return F.try_element_at(c, pos.cast("int"))


def band(c: Column | str, bands: list[tuple[float, str]], above: str, closed: bool = True) -> Column:
    """Label of the first band whose upper edge holds ``c`` (``<=`` if closed, else ``<``)."""
    c = as_col(c)
    chain = None
    for edge, label in bands:
        test = (c <= edge) if closed else (c < edge)
        chain = F.when(test, label) if chain is None else chain.when(test, label)
    return chain.otherwise(above)


# Upper edges of the PM2.5 bands and their names.
AIR_QUALITY_BANDS = [
    (12.0, "Good"),
    (35.4, "Moderate"),
    (55.4, "Unhealthy for Sensitive Groups"),
    (150.4, "Unhealthy"),
    (250.4, "Very Unhealthy"),
]
AIR_QUALITY_ABOVE = "Hazardous"

# View-count bands, upper edges exclusive.
POPULARITY_BANDS = [
    (1_000_000, "Low (< 1M)"),
    (10_000_000, "Medium (1M-10M)"),
    (100_000_000, "High (10M-100M)"),
]
POPULARITY_ABOVE = "Viral (100M+)"


def band_sql(c: str, bands: list[tuple[float, str]], above: str, closed: bool = True) -> str:
    """The SQL form of :func:`band`."""
    sign = "<=" if closed else "<"
    return "CASE " + " ".join(f"WHEN {c} {sign} {edge} THEN '{label}'" for edge, label in bands) + f" ELSE '{above}' END"


def air_quality(c: Column | str) -> Column:
    return band(c, AIR_QUALITY_BANDS, AIR_QUALITY_ABOVE)


def popularity(c: Column | str) -> Column:
    return band(c, POPULARITY_BANDS, POPULARITY_ABOVE, closed=False)


def rank_of(c: Column | str, order: list[str]) -> Column:
    """Position of a label in ``order``; unknown labels come last."""
    c = as_col(c)
    chain = F.when(c == order[0], 1)
    for i, label in enumerate(order[1:], start=2):
        chain = chain.when(c == label, i)
    return chain.otherwise(len(order) + 1)
