"""Keys that keep a hot object or bucket from landing in one task.

Two ways are used. Part rows are grouped and joined by (object, block of parts): a huge object is
many blocks and an ordinary one is a single block, so the object side grows only where the parts
do. Rows without part numbers get a salt, and the small side one copy for each salt.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partwise.limits import BLOCK_BITS

SALTS = 16

# Rows of narrow tables that are broadcast without harm: some ten megabytes.
BROADCAST_ROWS = 100_000


def broadcast_if_small(df: DataFrame, rows: int) -> DataFrame:
    """df to be broadcast where the counted rows allow it, else left to a shuffle join."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def block_of(part_num: Column) -> Column:
    """Number of the block a part is in, as BIGINT."""
    return F.shiftright(part_num.cast("bigint"), BLOCK_BITS)


def salted_join(
    facts: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    spread: Sequence[str],
    how: str = "left",
    salts: int = SALTS,
) -> DataFrame:
    """Join many fact rows for each key to a dimension with one row for each key.

    spread names fact columns that differ between the rows of one key.
    """
    salted = facts.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)))
    # A cross join and no explode: Spark takes an array for one row, and would broadcast the copies of a large dim.
    copies = dim.crossJoin(dim.sparkSession.range(salts).select(F.col("id").alias("_salt")))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")


def join_by_block(
    parts: DataFrame,
    objects: DataFrame,
    n_parts: Column,
    how: str = "inner",
    key: str = "object_id",
    rows: int | None = None,
) -> DataFrame:
    """Join part rows to object rows; objects are repeated once for each block of their parts.

    n_parts is the number of parts the object may have; with inner and left_semi joins, parts past
    the last block have no partner. rows is the number of blocks in all, where it was counted.
    """
    last = block_of(F.greatest(n_parts, F.lit(1)) - 1)
    blocks = objects.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    if rows is not None:
        blocks = broadcast_if_small(blocks, rows)
    return (
        parts.withColumn("_block", block_of(F.col("part_num")))
        .join(blocks, [key, "_block"], how)
        .drop("_block")
    )
