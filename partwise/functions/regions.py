"""Bucket location, region and endpoint. One region has the empty location."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The store's own names.
DEFAULT_REGION = "us-east-1"
DEFAULT_ENDPOINT = "https://s3.amazonaws.com"


def location_to_region(location: Column) -> Column:
    return F.when(location == "", F.lit(DEFAULT_REGION)).otherwise(location)


def region_to_location(region: Column) -> Column:
    return F.when(region == DEFAULT_REGION, F.lit("")).otherwise(region)


def endpoint_url(location: Column) -> Column:
    return F.when(location == "", F.lit(DEFAULT_ENDPOINT)).otherwise(
        F.concat(F.lit("https://s3-"), location, F.lit(".amazonaws.com"))
    )
