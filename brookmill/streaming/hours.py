"""Hourly sums of a stream that keep the rows that come too late.

A watermark of the engine drops late rows without a trace. Here every
micro-batch stores partial sums of its own, and what belongs to an hour that was
closed before the batch began goes to a side table. An hour is closed once the
newest row of the earlier batches is ``late`` seconds past its end.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brookmill.operators import tables


class HourlySums:
    """Sums per hour of ``ts`` and ``keys``; ``sums`` maps names to expressions, ``n`` counts rows. All parts of a batch are replaced when it is replayed."""

    def __init__(self, spark: SparkSession, path: str, ts: str, keys: list[str], sums: dict[str, Column], late: int = 3600) -> None:
        self.spark, self.path, self.ts, self.keys, self.sums, self.late = spark, path, ts, keys, sums, late

    def _newest(self, before: int | None = None) -> dt.datetime | None:
        """The newest time of the batches before one (None: of all)."""
        if not tables.exists(self.spark, f"{self.path}/newest"):
            return None
        seen = self.spark.read.schema("newest timestamp_ntz, batch_id long").parquet(f"{self.path}/newest")
        if before is not None:
            seen = seen.filter(F.col("batch_id") < before)
        return seen.agg(F.max("newest").alias("t")).first()["t"]

    def _closed(self, hour: Column, newest: dt.datetime | None) -> Column:
        if newest is None:
            return F.lit(False)
        return hour + F.expr("INTERVAL 1 HOUR") <= F.lit(newest - dt.timedelta(seconds=self.late)).cast("timestamp_ntz")

    def add(self, df: DataFrame, batch: int) -> None:
        """One micro-batch. Rows without a time count as late: no hour can take them."""
        ts = F.col(self.ts).cast("timestamp_ntz")
        rows = df.withColumn("hour", F.date_trunc("hour", ts).cast("timestamp_ntz"))
        late = F.col("hour").isNull() | self._closed(F.col("hour"), self._newest(batch))
        part = lambda name: f"{self.path}/{name}/batch_id={batch}"
        rows.filter(late).drop("hour").write.mode("overwrite").parquet(part("late"))
        sums = rows.filter(~late).groupBy("hour", *self.keys).agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(name) for name, c in self.sums.items()])
        sums.write.mode("overwrite").parquet(part("sums"))
        # The newest time goes last: a batch that failed before moves no watermark.
        df.agg(F.max(ts).alias("newest")).coalesce(1).write.mode("overwrite").parquet(part("newest"))

    def closed_hours(self) -> DataFrame:
        """Hours that can no longer change."""
        parts = self.spark.read.parquet(f"{self.path}/sums").filter(self._closed(F.col("hour"), self._newest()))
        return parts.groupBy("hour", *self.keys).agg(F.sum("n").alias("n"), *[F.sum(name).alias(name) for name in self.sums])

    def late_rows(self) -> DataFrame:
        """All rows that came too late, with the batch that brought them."""
        return self.spark.read.parquet(f"{self.path}/late")
