"""Scenarios that need files, a store or a stream; all content comes from the given tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fixtures.views import P, Views, attempts
from partwise.operators import crypto
from partwise.operators.integrity import composite_etags, part_digests
from partwise.operators.parts import split_parts
from partwise.plans.store import Store
from partwise.sources.files import local_path, partial_path
from partwise.sources.scratch import materialise, scratch_path
from partwise.sources.sinks import bucket_id, publish_objects


def scratch_folder(v: Views, name: str) -> str:
    path = local_path(scratch_path(v.spark, name))
    if path is None:
        raise RuntimeError("files are written in place: spark.checkpoint.dir has to be a mounted path")
    return path


def placed_parts(v: Views, folder: str) -> DataFrame:
    """Parts of all documents with the file each belongs to."""
    file = F.concat_ws("/", F.lit(folder), "bucket", "key")
    named = v.objects().withColumn("dst_path", file)
    return split_parts(named.select("object_id", "dst_path", "content"), P)


def published(v: Views, name: str) -> str:
    """Folder that holds every document as a file BUCKET/LANG/ID.txt."""
    folder = scratch_folder(v, name)
    publish_objects(placed_parts(v, folder))
    return folder


def object_id(url: str = "url"):
    return F.regexp_extract(url, r"([0-9]+)\.txt$", 1).cast("bigint")


def stored_rows(parts: DataFrame) -> DataFrame:
    """parts with upload_id, object_key and bytes as rows of the parts table."""
    return parts.select(
        "upload_id",
        bucket_id("upload_id").alias("bucket_id"),
        "part_num",
        "start",
        "end",
        F.col("start").alias("offset"),
        crypto.encrypted(F.col("bytes"), F.col("object_key")).alias("bytes"),
        F.coalesce("md5", F.md5("bytes")).alias("md5"),
        F.col("object_key").isNotNull().alias("is_encrypted"),
        F.lit(None).cast("string").alias("reject_reason"),
        F.lit("fixture").alias("attempt"),
    )


def full_store(v: Views, name: str) -> Store:
    """A store with every document, each under its key; kBad counts as none."""
    store = Store(v.spark, scratch_path(v.spark, name)).create()
    objects = v.keyed_objects().withColumn("key_id", F.when(F.col("key_id") != "kBad", F.col("key_id")))
    keys = crypto.derive_object_keys(objects.drop("content"), crypto.read_keys(v.key_table()))
    keyed = objects.join(keys.select("object_id", "object_key", "key_md5_b64"), "object_id")
    uploads = keyed.withColumn("upload_id", F.concat(F.lit("up-"), "object_id"))
    parts = split_parts(uploads.select("object_id", "upload_id", "object_key", "content"), P).withColumn("md5", F.md5("bytes"))
    store.append("parts", stored_rows(parts))
    etags = composite_etags(part_digests(v.parts())).drop("size")
    store.append(
        "objects",
        uploads.join(etags, "object_id").withColumn("part_size", F.lit(P).cast("bigint")).withColumn("published_at", F.current_timestamp()),
    )
    return store


def half_done_store(v: Views, name: str) -> Store:
    """A store in the state of dest, pending and completed."""
    store = Store(v.spark, scratch_path(v.spark, name)).create()
    dest = v.dest().select("object_id", "etag", "key_id")
    there = v.manifest().join(dest, "object_id")
    keys = crypto.derive_object_keys(there, crypto.read_keys(v.key_table())).select("object_id", "key_md5_b64")
    store.append(
        "objects",
        there.join(keys, "object_id")
        .withColumn("upload_id", F.concat(F.lit("old-"), "object_id"))
        .withColumn("part_size", F.lit(P).cast("bigint"))
        .withColumn("published_at", F.current_timestamp()),
    )
    begun = v.pending().withColumn("part_size", F.lit(P).cast("bigint")).withColumn("initiated", F.current_timestamp())
    store.append("uploads", begun)
    done = v.completed().select("upload_id", "object_id", "part_num", "size")
    parts = v.parts().join(done, ["object_id", "part_num"]).withColumn("object_key", F.lit(None).cast("string"))
    odd = parts.withColumn("md5", F.md5("bytes")).withColumn("end", F.col("start") + F.col("size"))
    store.append("parts", stored_rows(odd))
    return store


def transfer_requests(v: Views, folder: str) -> DataFrame:
    return v.requests().join(v.manifest().select("object_id", "location"), "object_id").select(
        "object_id",
        F.concat_ws("/", F.lit(folder), "bucket", "key").alias("src_url"),
        F.concat(F.lit("s3://"), "bucket", F.lit("/"), "key").alias("dst_url"),
        "exists",
        "resume_mode",
        "part_size",
        "key_id",
        "location",
    )


def store_requests(v: Views) -> DataFrame:
    """One request for each object of full_store, with its key."""
    return v.keyed_objects().select(
        "object_id",
        F.concat(F.lit("s3://"), "bucket", F.lit("/"), "key").alias("src_url"),
        F.when(F.col("key_id") != "kBad", F.col("key_id")).alias("key_id"),
    )


def event_stream(v: Views) -> DataFrame:
    schema = v.table("events").schema
    stream = v.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(v.sf_dir)
    return attempts(stream).filter("ok").withColumn("size", F.lit(P).cast("bigint"))


def rename_old(files: DataFrame) -> None:
    """Give partial files of NAME.old the name NAME: destinations that were there before."""

    def rename_all(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                os.replace(partial_path(path), path.removesuffix(".old"))
            yield batch

    files.mapInArrow(rename_all, files.schema).write.format("noop").mode("overwrite").save()


def run_to_end(writer) -> None:
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
