"""A dictionary beside a stream, in stored snapshots with a lifetime.

A micro-batch that is replayed must meet the dictionary it met before, and the
dictionary must not be read anew for every batch. So it is stored as numbered
snapshots, each used for a time between two bounds, and every batch notes the
snapshot it used.
"""

from __future__ import annotations

import time
import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brookmill.operators.tables import exists


class PinnedDictionary:
    """``read`` gives the dictionary as it is now; snapshots and notes are kept at ``path``.

    A snapshot is renewed after ``least`` to ``most`` seconds; which moment
    within is drawn by its number, so that many streams do not all read at once.
    ``clock`` is the time in seconds.
    """

    def __init__(self, spark: SparkSession, path: str, read: Callable[[], DataFrame], least: float = 300, most: float = 600, clock: Callable[[], float] = time.time) -> None:
        if not 0 <= least <= most:
            raise ValueError("least is not over most")
        self.spark, self.path, self.read, self.least, self.most, self.clock = spark, path, read, least, most, clock

    def lifetime(self, version: int) -> float:
        return self.least + (self.most - self.least) * (zlib.crc32(f"{self.path}:{version}".encode()) / 2**32)

    def _newest(self) -> tuple[int, float] | None:
        """Number and time of the newest complete snapshot."""
        if not exists(self.spark, f"{self.path}/versions"):
            return None
        return next(((r["version"], r["at"]) for r in self.spark.read.parquet(f"{self.path}/versions").orderBy(F.desc("version")).take(1)), None)

    def _current(self) -> int:
        newest = self._newest()
        if newest and self.clock() < newest[1] + self.lifetime(newest[0]):
            return newest[0]
        version, at = (newest[0] + 1 if newest else 0), self.clock()
        self.read().write.mode("overwrite").parquet(f"{self.path}/snapshots/{version}")
        # A snapshot counts once it is written as a whole.
        self.spark.createDataFrame([(version, at)], "version int, at double").coalesce(1).write.mode("append").parquet(f"{self.path}/versions")
        return version

    def for_batch(self, batch: int) -> DataFrame:
        """The dictionary of a micro-batch, the same at every call for it."""
        note = f"{self.path}/batches/{batch}"
        if exists(self.spark, f"{note}/_SUCCESS"):
            version = self.spark.read.parquet(note).first()["version"]
        else:
            version = self._current()
            self.spark.createDataFrame([(version,)], "version int").coalesce(1).write.mode("overwrite").parquet(note)
        return self.spark.read.parquet(f"{self.path}/snapshots/{version}")

    def enriching(self, enrich: Callable[[DataFrame, DataFrame], DataFrame]) -> Callable[[DataFrame, int], DataFrame]:
        """Batch transform for :func:`brookmill.streaming.ingest.batch_writer`."""
        return lambda df, batch: enrich(df, self.for_batch(batch))
