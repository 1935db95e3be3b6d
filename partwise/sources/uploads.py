"""State of unfinished uploads from listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

UPLOAD_SCHEMA = "UploadId string, Bucket string, Key string, Initiated timestamp"
PART_FIELDS = "PartNumber bigint, Size bigint, ETag string, LastModified timestamp"
PART_SCHEMA = f"UploadId string, {PART_FIELDS}"
PART_PAGE_SCHEMA = f"Bucket string, Key string, UploadId string, Part array<struct<{PART_FIELDS.replace(' bigint', ': bigint').replace(' string', ': string').replace(' timestamp', ': timestamp')}>>"


def read_upload_state(
    spark: SparkSession, uploads: str, parts: str, fmt: str = "parquet"
) -> tuple[DataFrame, DataFrame]:
    """(pending_uploads, completed_parts) from tables of listings.

    fmt is parquet or json with one row for each upload and each part, or xml with the store's own
    pages: Upload elements, and one ListPartsResult for each page of parts. Listed part numbers
    start from 1 and etags are quoted; here they start from 0 and are not.
    """
    def read(path: str, schema: str, tag: str) -> DataFrame:
        reader = spark.read.format(fmt).schema(schema)
        return (reader.option("rowTag", tag) if fmt == "xml" else reader).load(path)

    listed = read(uploads, UPLOAD_SCHEMA, "Upload")
    if fmt == "xml":
        pages = read(parts, PART_PAGE_SCHEMA, "ListPartsResult")
        done = pages.select("UploadId", F.inline("Part"))
    else:
        done = read(parts, PART_SCHEMA, "Part")
    pending = listed.select(
        F.col("UploadId").alias("upload_id"),
        F.col("Bucket").alias("bucket"),
        F.col("Key").alias("key"),
        F.col("Initiated").alias("initiated"),
    )
    completed = done.select(
        F.col("UploadId").alias("upload_id"),
        (F.col("PartNumber") - 1).alias("part_num"),
        F.col("Size").alias("size"),
        F.regexp_replace("ETag", '^"|"$', "").alias("etag"),
    )
    return pending, completed
