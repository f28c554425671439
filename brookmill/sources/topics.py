"""Topics: keyed JSON messages.

A topic table has the columns of Spark's Kafka source: key, value, partition,
offset, timestamp. The format is a parameter; a folder of such rows stands in
where no broker is at hand.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brookmill.operators.tables import exists

TOPIC_SCHEMA = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)


def message_key(*parts: Column | str) -> Column:
    """Key text of a message: 'US_2024-01-01', blanks as '_'."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.replace(F.concat_ws("_", *cols), F.lit(" "), F.lit("_"))


def to_messages(df: DataFrame, key: Column, columns: list[str] | None = None) -> DataFrame:
    """Rows as (key, value) with the row as JSON; NULL fields are written out."""
    body = F.to_json(F.struct(*(columns or df.columns)), {"ignoreNullFields": "false"})
    return df.select(key.alias("key"), body.alias("value"))


def write_messages(messages: DataFrame, fmt: str, **options: Any) -> None:
    messages.write.format(fmt).mode("append").options(**options).save()


def as_topic_rows(messages: DataFrame, ts: Column, offset: Column, partitions: int = 8) -> DataFrame:
    """Complete messages to topic rows, for a folder that stands in for a broker."""
    return messages.select(
        "key",
        "value",
        F.pmod(F.xxhash64("key"), F.lit(partitions)).cast("int").alias("partition"),
        offset.cast("long").alias("offset"),
        ts.cast("timestamp").alias("timestamp"),
    )


def read_stream(spark: SparkSession, fmt: str, schema: T.StructType | None = None, **options: Any) -> DataFrame:
    """Stream of topic rows. Kafka keys and values arrive as bytes and become text."""
    reader = spark.readStream.format(fmt).options(**options)
    df = (reader.schema(schema) if schema is not None else reader).load()
    return df.withColumns({c: F.col(c).cast("string") for c in ("key", "value") if c in df.columns})


def read_batch(spark: SparkSession, fmt: str, schema: T.StructType | None = None, **options: Any) -> DataFrame:
    """Bounded read of a topic (``startingOffsets``/``endingOffsets`` for a broker)."""
    reader = spark.read.format(fmt).options(**options)
    df = (reader.schema(schema) if schema is not None else reader).load()
    return df.withColumns({c: F.col(c).cast("string") for c in ("key", "value") if c in df.columns})


class OffsetBatches:
    """Bounded batches of a topic by stored offset ranges.

    The ranges of a batch, (partition, start, end) with end exclusive, are
    stored before anything is read, and every batch begins where the one before
    ended. So batches neither overlap nor leave a gap, and a batch that is read
    again gives the rows it gave before, whatever has arrived since.
    """

    _SCHEMA = T.StructType([T.StructField("partition", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("batch", T.LongType())])

    def __init__(self, topic: DataFrame, path: str) -> None:
        self.topic, self.spark, self.path = topic, topic.sparkSession, path

    def ranges(self) -> DataFrame:
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], self._SCHEMA)
        return self.spark.read.schema(self._SCHEMA).parquet(self.path).select(*self._SCHEMA.fieldNames())

    def _of(self, batch: int) -> list:
        return self.ranges().filter(F.col("batch") == batch).orderBy("partition").collect()

    def plan(self, batch: int, most: int | None = None) -> int:
        """Store the ranges of ``batch``, with at most ``most`` offsets of each partition; returns how many partitions have any.

        A batch planned before keeps its ranges. Only the offsets are read, and
        of these the ones behind the last batch.
        """
        if known := self._of(batch):
            return len(known)
        before = self.ranges().groupBy("partition").agg(F.max("end").alias("done"))
        done = {r["partition"]: r["done"] for r in before.collect()}
        rows = self.topic.select("partition", "offset").filter(F.col("offset").isNotNull())
        if done:
            rows = rows.filter(F.col("offset") >= min(done.values())).join(F.broadcast(before), "partition", "left").filter(F.col("done").isNull() | (F.col("offset") >= F.col("done")))
        seen = rows.groupBy("partition").agg(F.min("offset").alias("first"), (F.max("offset") + 1).alias("latest"))
        seen = seen.join(F.broadcast(before), "partition", "left") if done else seen.withColumn("done", F.lit(None).cast("long"))
        start = F.coalesce("done", "first")
        end = F.least(F.col("latest"), start + most) if most else F.col("latest")
        planned = seen.select(F.col("partition").cast("int").alias("partition"), start.alias("start"), end.alias("end"))
        planned.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch={batch}")
        return len(self._of(batch))

    def read(self, batch: int) -> DataFrame:
        """The messages of a planned batch. The ranges reach the scan as filters, one for each partition of the topic."""
        test = F.lit(False)
        for r in self._of(batch):
            test = test | ((F.col("partition") == r["partition"]) & (F.col("offset") >= r["start"]) & (F.col("offset") < r["end"]))
        return self.topic.filter(test)

    def broker_options(self, batch: int, topic: str) -> dict[str, str]:
        """The same ranges as options of a broker's batch source, which plans one task or more for each."""
        ranges = self._of(batch)
        ends = {key: json.dumps({topic: {str(r["partition"]): r[key] for r in ranges}}) for key in ("start", "end")}
        return {"startingOffsets": ends["start"], "endingOffsets": ends["end"]}


def decode(topic: DataFrame, schema: T.StructType, keep: list[str] | None = None) -> DataFrame:
    """JSON values as columns plus ``_corrupt``, the text of a message that is not valid."""
    wide = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    parsed = F.from_json("value", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    return topic.select(*(keep or []), parsed.alias("r")).select(*(keep or []), "r.*")
