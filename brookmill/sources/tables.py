"""Tables by name, and unions of tables picked by a name pattern."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


class Tables:
    """Parquet tables of one folder as attributes: ``Tables(spark, dir).orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in NAMES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def union_matching(tables: dict[str, DataFrame], pattern: str) -> DataFrame:
    """Rows of every table whose name matches; columns missing in one are NULL there."""
    picked = [df for name, df in sorted(tables.items()) if re.search(pattern, name)]
    if not picked:
        raise ValueError(f"no table matches {pattern}")
    out = picked[0]
    for df in picked[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out
