"""Selection of whole rows by decisions about them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> Column:
    """The column of this very name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names``, lengthened until ``df`` has no column of that name in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name in taken:
            name += "_"
        out.append(name)
    return out


def _id(key: str) -> Column:
    return F.coalesce(quoted(key).cast("long"), F.lit(-(2**63)))


def _picked(chosen: DataFrame, key: str, digest: Column, names: list[str]) -> DataFrame:
    return chosen.select(_id(key).alias(names[0]), digest.alias(names[1])).distinct()


def rows_where(df: DataFrame, chosen: DataFrame, key: str, digest: Column, chosen_digest: Column, how: str = "left_semi") -> DataFrame:
    """The rows of ``df`` whose (key, digest) is among ``chosen``, or with ``how="left_anti"`` is not, with all columns.

    Null keys equal each other. Columns may have any names.
    """
    names = unused(df, "row_id", "row_digest")
    marked = df.select("*", _id(key).alias(names[0]), digest.alias(names[1]))
    return marked.join(_picked(chosen, key, chosen_digest, names), names, how).select(*[quoted(c) for c in df.columns])


def one_row_where(df: DataFrame, chosen: DataFrame, key: str, digest: Column, chosen_digest: Column, order: Column) -> DataFrame:
    """Like :func:`rows_where`, but one row for each (key, digest): the first by ``order``, of equals the one of smallest row hash.

    The join has placed the rows by these columns, so the second step moves nothing.
    """
    names = unused(df, "row_id", "row_digest", "row_order", "row_hash", "row_place")
    hashed = [quoted(f.name) if isinstance(f.dataType, (T.AtomicType, T.NullType)) else F.to_json(F.struct(quoted(f.name))) for f in df.schema]
    marked = df.select("*", _id(key).alias(names[0]), digest.alias(names[1]), order.alias(names[2]), F.xxhash64(*hashed).alias(names[3]))
    joined = marked.join(_picked(chosen, key, chosen_digest, names), names[:2], "left_semi")
    place = F.row_number().over(Window.partitionBy(*names[:2]).orderBy(*names[2:4]))
    return joined.select("*", place.alias(names[4])).filter(F.col(names[4]) == 1).select(*[quoted(c) for c in df.columns])
