"""New files transferred as they appear."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from partwise.limits import MIN_PART_SIZE
from partwise.plans.store import Store
from partwise.plans.transfer import run_transfer
from partwise.sources.files import local_path
from partwise.sources.scratch import materialise
from partwise.streaming.listing import new_objects

def stream_objects(
    store: Store,
    directory: str,
    dst_url: str,
    checkpoint: str,
    part_size: int = MIN_PART_SIZE,
    exists: str = "skip",
    key_id: str | None = None,
    location: str = "",
    keys: DataFrame | None = None,
    max_files: int | None = None,
) -> DataStreamWriter:
    """Writer that transfers each new file, empty ones too, to dst_url followed by its path below directory.

    A batch is the files that a listing found new, and looks at no other; the listing lies below checkpoint.
    It is transferred max_files at a time. A batch that is repeated after a failure resumes its unfinished
    uploads and, with exists "skip", leaves alone what it had finished: each file is transferred once.
    """
    base = (local_path(directory) or directory).rstrip("/") + "/"
    bucket_prefix = dst_url.removeprefix("s3://").partition("/")[2]

    def transfer(batch: DataFrame, batch_id: int) -> None:
        below = F.expr("substring(url, length(_base) + 1)")
        # Names of files are paths and keys as they are: what looks like a query in them is none.
        named = batch.withColumn("_base", F.lit(base)).select(
            F.monotonically_increasing_id().alias("object_id"),
            F.col("url").alias("src_url"),
            F.lit(dst_url).alias("dst_url"),
            F.concat(F.lit(bucket_prefix), below).alias("dst_key"),
            F.lit(exists).alias("exists"),
            F.lit("resume").alias("resume_mode"),
            F.lit(part_size).cast("bigint").alias("part_size"),
            F.lit(key_id).cast("string").alias("key_id"),
            F.lit(location).alias("location"),
        )
        n = batch.count()
        if n == 0:
            return
        runs = -(-n // max_files) if max_files else 1
        listed = materialise(named.withColumn("_run", F.pmod(F.xxhash64("dst_key"), F.lit(runs))), "batch")
        for run in range(runs):
            run_transfer(store, listed.filter(F.col("_run") == run).drop("_run"), keys)

    return (
        new_objects(store.spark, directory, f"{checkpoint.rstrip('/')}/listing")
        .writeStream.foreachBatch(transfer)
        .option("checkpointLocation", checkpoint)
    )
