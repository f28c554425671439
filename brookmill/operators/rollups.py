"""Rollup tables: state rows per batch, merged when read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brookmill.operators import tables
from brookmill.scratch import cut


def sum_states(df: DataFrame, keys: list[str], sums: dict[str, Column]) -> DataFrame:
    """Partial sums and row count per key: the state rows of one batch."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows_count"), *[F.sum(c).alias(f"{n}_sum") for n, c in sums.items()]
    )


def merge_sums(states: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Final sums of state rows."""
    return states.groupBy(*keys).agg(*[F.sum(f"{n}_sum").alias(n) for n in names])


class Rollup:
    """State rows by batch, and merged states by version.

    ``batches/batch_id=.../<period>=...`` holds what came in. Writing a batch
    again replaces its folder as a whole, so a replay counts nothing twice and
    a corrected batch leaves no old period behind.

    ``merged/version=.../<period>=...`` holds periods that were compacted or
    rebuilt, and ``taken/version=...`` which (period, batch) pairs each version
    took in. ``taken`` is written last and makes its version count: a run that
    fails before leaves the view as it was. Of a period the newest version
    counts, plus the batches it did not take. A batch that is repeated after a
    compaction took it in therefore still counts once; a corrected one changes
    nothing in those periods (:meth:`rebuild` does).
    """

    def __init__(self, spark, path: str, period: str, keys: list[str], sums: dict[str, Column]):
        self.spark, self.path, self.period, self.keys, self.sums = spark, path, period, keys, sums
        self._schema: T.StructType | None = None

    def _state_schema(self) -> T.StructType:
        """Columns of the state rows; known from the first batch written here, else read from the files once."""
        if self._schema is None:
            stored = self.spark.read.parquet(f"{self.path}/batches").schema
            fields = [f for f in stored if f.name not in (self.period, "batch_id")]
            self._schema = T.StructType([*fields, T.StructField(self.period, T.IntegerType())])
        return self._schema

    def _read(self, folder: str, extra: T.StructField) -> DataFrame:
        """Rows below a folder; none where it is missing or holds no rows."""
        schema = T.StructType([*self._state_schema(), extra])
        if not tables.exists(self.spark, f"{self.path}/{folder}"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{folder}").select(*schema.fieldNames())

    def _taken(self) -> DataFrame:
        """(version, period, batch_id) of all versions that count; batch_id is null where a version took no batch."""
        schema = T.StructType.fromDDL(f"`{self.period}` int, batch_id string, version int")
        if not tables.exists(self.spark, f"{self.path}/taken"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/taken").select(*schema.fieldNames())

    def states(self, df: DataFrame) -> DataFrame:
        keyed = [k for k in self.keys if k != self.period]
        states = sum_states(df, [*keyed, self.period], self.sums)
        return states.withColumn(self.period, F.col(self.period).cast("int"))

    def add_batch(self, df: DataFrame, batch_id: str) -> None:
        """Write the state rows of one batch in place of any it wrote before. ``df`` must carry the period column."""
        states = self.states(df)
        keyed = [f for f in states.schema if f.name != self.period]
        self._schema = self._schema or T.StructType([*keyed, states.schema[self.period]])
        target = f"{self.path}/batches/{tables.segment({'batch_id': batch_id})}"
        tables.write_partitioned(states, target, [self.period], "overwrite")

    def backfill(self, base: DataFrame, before: Column, batch_id: str = "backfill") -> None:
        """Add base rows the view never saw. ``before`` tells them from rows that came as batches."""
        self.add_batch(base.filter(before), batch_id)

    def _current(self, periods: list[int] | None = None) -> DataFrame:
        """The state rows that count. Without any version these are the batches: one look at the folder, no join."""
        if not tables.exists(self.spark, f"{self.path}/taken"):
            batches = self._read("batches", T.StructField("batch_id", T.StringType())).drop("batch_id")
            return batches if periods is None else batches.filter(F.col(self.period).isin(periods))
        merged = self._read("merged", T.StructField("version", T.IntegerType()))
        batches = self._read("batches", T.StructField("batch_id", T.StringType()))
        if periods is not None:
            merged, batches = (df.filter(F.col(self.period).isin(periods)) for df in (merged, batches))
        taken = self._taken()
        newest = taken.groupBy(self.period).agg(F.max("version").alias("version"))
        # A batch may be repeated under its name after any version took it, so every version's pairs count.
        pairs = taken.select(self.period, "batch_id").distinct()
        kept = merged.join(newest, [self.period, "version"], "left_semi").drop("version")
        return kept.unionByName(batches.join(pairs, [self.period, "batch_id"], "left_anti").drop("batch_id"))

    def read(self, keys: list[str] | None = None, periods: list[int] | None = None) -> DataFrame:
        return merge_sums(self._current(periods), keys or self.keys, list(self.sums))

    def _replace(self, states: DataFrame, periods: list[int]) -> None:
        """Put ``states`` in place of everything the periods hold now."""
        version = (self._taken().agg(F.max("version").alias("v")).first()["v"] or 0) + 1
        batches = self._read("batches", T.StructField("batch_id", T.StringType()))
        took = batches.filter(F.col(self.period).isin(periods)).select(self.period, "batch_id").distinct()
        none = self.spark.createDataFrame([(p, None) for p in periods], f"`{self.period}` int, batch_id string")
        pairs = cut(took.unionByName(none), "rollup-taken")
        tables.write_partitioned(states, f"{self.path}/merged/version={version}", [self.period], "overwrite")
        pairs.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/taken/version={version}")

    def rebuild(self, base: DataFrame, periods: list[int]) -> None:
        """Recompute periods after base rows were changed in place, as a new version."""
        self._replace(self.states(base.filter(F.col(self.period).isin(periods))), periods)

    def compact(self, periods: list[int]) -> None:
        """Merge the batches of periods into one set of state rows, as a new version.

        No batch of these periods may be written at the same time.
        """
        names = [f"{n}_sum" for n in self.sums]
        merged = self._current(periods).groupBy(*[k for k in self.keys if k != self.period], self.period)
        sums = merged.agg(F.sum("rows_count").alias("rows_count"), *[F.sum(n).alias(n) for n in names])
        self._replace(sums.select(*self._state_schema().fieldNames()), periods)


def drift(base: DataFrame, view: DataFrame, keys: list[str], values: list[str], digits: int = 2) -> DataFrame:
    """Keys where the stored view no longer agrees with the base aggregate."""
    b = base.select(*keys, *[F.col(v).alias(f"base_{v}") for v in values])
    w = view.select(*keys, *[F.col(v).alias(f"view_{v}") for v in values])
    same = F.lit(True)
    for v in values:
        same = same & F.round(f"base_{v}", digits).eqNullSafe(F.round(f"view_{v}", digits))
    return b.join(w, keys, "full_outer").filter(~same)
