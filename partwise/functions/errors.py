"""User errors as data: a class name and an exit code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Scripts branch on these exit codes.
EXIT_CODES = {
    "UserError": 2,
    "ObjectExists": 3,
    "UploadExists": 4,
    "InvalidSourceURL": 5,
    "InvalidDestinationURL": 6,
    "InvalidS3URL": 7,
    "IncompatiblePartSize": 8,
    "InvalidChecksumAlgorithm": 9,
    "InvalidEncryptionKey": 10,
    "FileExists": 11,
    "DownloadExists": 12,
    "MultipleUploadsExist": 13,
    "PermissionDenied": 14,
}

# Failures that are not user errors: the process would end with a plain 1.
INTERNAL_ERROR_CODE = 1


def exit_code(error_class: Column) -> Column:
    """Exit code of an error class; 1 for a class outside the table, NULL for NULL."""
    table = F.create_map(*[F.lit(x) for pair in EXIT_CODES.items() for x in pair])
    return F.when(
        error_class.isNotNull(),
        F.coalesce(F.try_element_at(table, error_class), F.lit(INTERNAL_ERROR_CODE)),
    ).cast("int")


def error_table(spark: SparkSession) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(k).alias("error_class"), F.lit(v).alias("exit_code")) for k, v in EXIT_CODES.items()])
    return spark.range(1, numPartitions=1).select(F.inline(rows))
