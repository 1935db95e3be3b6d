"""Small helpers that several operators use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partwise.sources.scratch import materialise  # noqa: F401  written to the shared folder and read back


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Two columns, `id` and the UTF-8 bytes `raw` (null text: empty); all others are left behind,
    so their names cannot clash with what an operator adds."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), text.cast("binary").alias("raw"))


def in_slices(batches, rows: int = 256):
    """Record batches in slices of a few rows: Python holds copies of one slice only."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
