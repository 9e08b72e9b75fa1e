"""Shared scratch space: where iterative jobs cut their lineage.

Everything written here goes to the folder the cluster names in
``spark.checkpoint.dir``, so that a lost executor can re-read it.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_root(spark: SparkSession) -> str:
    """The session's checkpoint folder; a local one only for a local master."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="affinity-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Jobs that end in here leave no shuffle files, which would else stay until the driver collects its garbage."""
    was = spark.conf.get(FREED)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(FREED, was)


def materialize(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write ``df`` to the scratch folder and read it back.

    Cuts the lineage and gives the planner real sizes, so a small table is
    broadcast and a large one is not. What was shuffled for it is dropped.
    """
    path = scratch_path(df.sparkSession, label)
    with freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_bucketed(df: DataFrame, keys: list[str], label: str = "cut") -> DataFrame:
    """Like :func:`materialize`, in one sorted bucket per shuffle partition of ``keys``.

    Joins on the keys then read the buckets without shuffling them, however
    often. The name that a bucketed write needs is taken out of the catalogue
    again; the files stay.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"{label}_{uuid.uuid4().hex}"
    laid = df.repartition(buckets, *keys)  # one file a bucket
    with freed(spark):
        laid.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", scratch_path(spark, label)).format("parquet").saveAsTable(name)
    held = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return held
