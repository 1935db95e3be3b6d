"""Tables a job writes to cut its lineage, in the folder the cluster shares."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; where none is set and all runs on one machine, one is made and set."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is not set: tables of a job need a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="partwise-")
        spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/partwise/{name}-{uuid.uuid4().hex}"


# Bytes in memory for each byte of a written table of names, digests and numbers.
UNPACKED = 10


def sizes_as_unpacked(spark: SparkSession) -> None:
    """For the session: files count as so much larger when Spark looks for tables to broadcast.

    What the driver builds for a broadcast takes some ten times the compressed bytes, by which Spark goes otherwise.
    """
    name = "spark.sql.sources.fileCompressionFactor"
    if float(spark.conf.get(name)) < UNPACKED:
        spark.conf.set(name, str(float(UNPACKED)))


def materialise(df: DataFrame, name: str) -> DataFrame:
    """df written once and read back.

    Later steps see the same rows although the tables df was made from change, a lost executor
    loses nothing, and Spark knows the size when it chooses whether to broadcast.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
