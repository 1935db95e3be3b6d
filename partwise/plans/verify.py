"""Digests of whole objects and files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partwise.operators.integrity import check_algorithm, fold_digests
from partwise.operators.rejects import with_exit_code
from partwise.plans.download import find_objects
from partwise.plans.store import Store
from partwise.sources.objects import digest_ranges
from partwise.sources.scratch import materialise


def run_verify(store: Store, requests: DataFrame, algo: str = "md5", keys: DataFrame | None = None) -> DataFrame:
    """(object_id, digest, error_class, exit_code) of objects in the store.

    requests: object_id, src_url, key_id. A digest over a whole object needs its bytes in order;
    where the etag is enough, compare that and read nothing. Ranges of the index are sorted by
    object, and each object's are read in order by one task: no byte is shuffled.
    """
    check_algorithm(algo)
    found, object_keys = find_objects(store, requests, keys)
    found = materialise(found, "found")
    good = found.filter(F.col("reject_reason").isNull()).select(
        "object_id", "upload_id", "size", F.col("src_part_size").alias("part_size")
    )
    # One part for each object: its ranges, in order, are read by one task.
    ranges = store.ranges(good.withColumn("_all", F.greatest("size", F.lit(1))), ["object_id", "_all"], F.col("_all"))
    keyed = good.withColumn("part_size", F.greatest("size", F.lit(1))).join(object_keys, "object_id") if keys is not None else None
    opened = store.opened(ranges, keyed)
    digests = fold_digests(opened, algo)
    result = found.select("object_id", F.col("reject_reason").alias("error_class")).join(digests, "object_id", "left")
    return with_exit_code(result.select("object_id", "digest", "error_class"))


def verify_files(objects: DataFrame, algo: str = "md5") -> DataFrame:
    """(object_id, digest) of files (object_id, url, size), each read in order by one task."""
    check_algorithm(algo)
    whole = objects.select(
        "object_id",
        "url",
        F.lit(0).cast("bigint").alias("part_num"),
        F.lit(0).cast("bigint").alias("start"),
        F.col("size").alias("end"),
    )
    return digest_ranges(whole, "object_id", algo).select("object_id", F.col(algo).alias("digest"))
