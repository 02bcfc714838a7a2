"""Where intermediate tables and sink targets live.

On a cluster every write goes under the shared folder named by
``spark.checkpoint.dir`` (read from the session); a machine-local folder
would vanish with the executor that wrote it. Only when the setting is
absent and driver and executors share one machine (tests, local runs) is a
fresh local folder created and registered; on a cluster that is an error.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one if unset."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(root)
        return root.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    root = tempfile.mkdtemp(prefix="cardsentry-")
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir().rstrip("/")


def new_location(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared root for one table or stream."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None) -> None:
    writer = df.write.mode(mode).format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage (a lost executor re-reads the file instead of
    recomputing the plan) and fixes non-deterministic inputs such as
    ``current_timestamp`` for every later reader.
    """
    spark = df.sparkSession
    path = new_location(spark, name)
    write_table(df, path)
    return spark.read.parquet(path)
