"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from brookmill.functions.types import as_col, round_to


def not_empty(c: Column | str) -> Column:
    """True for text that is neither NULL nor ''. Never NULL."""
    return F.coalesce(as_col(c), F.lit("")) != ""


def split_at(c: Column | str, separator: str, position: int) -> Column:
    """1-based piece of a split on a literal separator; '' outside the list."""
    return F.split_part(as_col(c), F.lit(separator), F.lit(position))


# Binary size units.
SIZE_UNITS = ("B", "KiB", "MiB", "GiB", "TiB", "PiB", "EiB")


def readable_size(c: Column | str) -> Column:
    """Bytes as text with two decimals and a binary unit, '1.50 KiB'.

    Rounded by :func:`round_to` first, as formatting alone rounds ties by engine.
    """
    c = as_col(c).cast("double")
    chain = None
    for power, unit in enumerate(SIZE_UNITS[:-1]):
        text = F.format_string(f"%.2f {unit}", round_to(c / float(1024**power), 2))
        test = F.abs(c) < float(1024 ** (power + 1))
        chain = F.when(test, text) if chain is None else chain.when(test, text)
    last = F.format_string(f"%.2f {SIZE_UNITS[-1]}", round_to(c / float(1024 ** (len(SIZE_UNITS) - 1)), 2))
    return F.when(c.isNotNull(), chain.otherwise(last))


# Markup characters and blanks inside a verbatim section, and their stand-ins
# from the private-use area while the tag patterns run.
_MARKUP = "<> \t\r\n"
_STAND_IN = "\ue000\ue001\ue002\ue003\ue004\ue005"


def _shield_verbatim(c: Column) -> Column:
    pieces = F.split(c, r"<!\[CDATA\[")
    shielded = F.transform(
        F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))),
        lambda p: F.when(
            F.instr(p, "]]>") > 0,
            F.concat(
                F.translate(F.substring_index(p, "]]>", 1), _MARKUP, _STAND_IN),
                F.substr(p, F.instr(p, "]]>") + 3),
            ),
        ).otherwise(F.translate(p, _MARKUP, _STAND_IN)),
    )
    return F.concat(F.element_at(pieces, 1), F.array_join(shielded, ""))


def html_text(c: Column | str) -> Column:
    """Readable text of an HTML page.

    Comments, scripts and styles go with their content, every other tag becomes
    one blank, runs of white space become one blank, entities stay as written,
    verbatim (CDATA) sections are kept as they are.
    """
    c = as_col(c)
    has_verbatim = F.contains(c, F.lit("<![CDATA["))
    s = F.when(has_verbatim, _shield_verbatim(c)).otherwise(c)
    s = F.regexp_replace(s, r"(?s)<!--.*?-->", " ")
    s = F.regexp_replace(s, r"(?is)<script\b[^>]*>.*?</script\s*>", " ")
    s = F.regexp_replace(s, r"(?is)<style\b[^>]*>.*?</style\s*>", " ")
    s = F.regexp_replace(s, r"(?s)<[^>]*>", " ")
    s = F.trim(F.regexp_replace(s, r"\s+", " "))
    return F.when(has_verbatim, F.translate(s, _STAND_IN, _MARKUP)).otherwise(s)
