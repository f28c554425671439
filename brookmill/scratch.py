"""Places for written intermediate tables.

Rewrites, rollups and streams need tables on storage every executor can reach.
They go below the folder named by ``spark.checkpoint.dir``. Only a local session
without that setting gets a folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_KEY = "spark.checkpoint.dir"
_local_root: str | None = None


def shared_root(spark: SparkSession) -> str:
    """Return the shared folder of this session."""
    global _local_root
    configured = spark.conf.get(_KEY, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_KEY} to a folder every executor can reach")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="brookmill-")
    return _local_root


def new_path(spark: SparkSession, name: str) -> str:
    """Return a path below the shared folder that nothing else uses."""
    return f"{shared_root(spark)}/brookmill/{name}-{uuid.uuid4().hex}"


def cut(df, name: str):
    """Write ``df`` to the shared folder and read it back.

    The result has no lineage, so a lost executor costs a re-read of files and
    not a re-run of the stages before. A value computed once (a sample, a range
    split) also stays the same for every later reader.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
