"""Part size requests as text, and byte counts for reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partwise.functions.sizes import bytes_to_text, size_text_to_bytes
from partwise.limits import MAX_PART_SIZE, MIN_PART_SIZE


def normalise_sizes(
    df: DataFrame, col: str, lo: int = MIN_PART_SIZE, hi: int | None = MAX_PART_SIZE
) -> DataFrame:
    """Add bytes and reject_reason. Uploads are bounded on both sides, downloads only by lo=1."""
    size = F.col("bytes")
    outside = (size < lo) if hi is None else (size < lo) | (size > hi)
    return df.withColumn("bytes", size_text_to_bytes(F.col(col))).withColumn(
        "reject_reason", F.when(size.isNull() | outside, F.lit("UserError"))
    )


def size_report(
    parts: DataFrame, by: Sequence[str], decimals: int = 1, symbols: str = "customary", suffix: str = ""
) -> DataFrame:
    """Parts and bytes for each group of by, the bytes also as text."""
    totals = parts.groupBy(*by).agg(
        F.count("*").alias("n_parts"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")
    )
    return totals.withColumn("human", bytes_to_text(F.col("bytes"), decimals, symbols, suffix))
