"""Locations of objects: classification, destination keys, regions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partwise.functions import locations as L
from partwise.functions import regions as R

# Endings kept for files of unfinished downloads.
RESERVED_SUFFIXES = r"\.(partial|progress)$"

SOURCE, STORE, FILE = "source", "store", "file"


def _not_in_store(url: Column) -> Column:
    return (url["scheme"] != "s3") | (url["authority"] == "") | ~url["path"].startswith("/")


def _reject_reason(url: Column, role: str) -> Column:
    foreign_host = (url["scheme"] == "file") & ~url["authority"].isin("", "localhost")
    if role == STORE:
        return F.when(_not_in_store(url), "InvalidS3URL")
    reason = F.when(foreign_host, "InvalidSourceURL")
    if role == SOURCE:
        return reason.when((url["scheme"] == "s3") & _not_in_store(url), "InvalidS3URL")
    if role == FILE:
        return reason.when(
            (url["scheme"] != "file") | url["path"].rlike(RESERVED_SUFFIXES), "InvalidDestinationURL"
        )
    raise ValueError(f"unknown role {role!r}")


def classify_locations(
    df: DataFrame, col: str, role: str = SOURCE, base_dir: str = "/"
) -> DataFrame:
    """Add scheme, authority, path, has_query and reject_reason of the location in col.

    role: "source" takes URLs and paths (paths become file URLs, relative ones below base_dir),
    "store" only s3://BUCKET/KEY, "file" only file URLs and paths to write to.
    """
    text = F.col(col)
    url = text if role == STORE else L.to_url(text, base_dir)
    empty = "InvalidS3URL" if role == STORE else "InvalidSourceURL"
    parsed = df.withColumn("_full", url).withColumn("_url", L.split_url(F.col("_full")))
    return parsed.select(
        *[F.col(c) for c in df.columns],
        F.col("_url.scheme").alias("scheme"),
        F.col("_url.authority").alias("authority"),
        F.col("_url.path").alias("path"),
        F.col("_full").rlike("[?#]").alias("has_query"),
        F.when(F.coalesce(text, F.lit("")) == "", F.lit(empty))
        .otherwise(_reject_reason(F.col("_url"), role))
        .alias("reject_reason"),
    )


def derive_destination(df: DataFrame, key_col: str = "key", path_col: str = "path") -> DataFrame:
    """Add dst_key: an empty key or one ending in "/" gets the file name of the source."""
    key = F.col(key_col)
    return df.withColumn(
        "dst_key",
        F.when((key == "") | key.endswith("/"), F.concat(key, L.basename(F.col(path_col)))).otherwise(key),
    )


def resolve_region(df: DataFrame, location_col: str = "location") -> DataFrame:
    """Add region, base_url and reject_reason; an unknown location is a missing permission."""
    location = F.col(location_col)
    return df.select(
        "*",
        R.location_to_region(location).alias("region"),
        F.when(location.isNotNull(), R.endpoint_url(location)).alias("base_url"),
        F.when(location.isNull(), F.lit("PermissionDenied")).alias("reject_reason"),
    )


def bucket_locations(df: DataFrame, region_col: str = "region") -> DataFrame:
    """The way back: add location for a region name."""
    return df.withColumn("location", R.region_to_location(F.col(region_col)))
