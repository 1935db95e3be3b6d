"""Shards of equal bytes by sampled splitters.

Records are ordered by a hash of their text, so equal texts lie side by side. A sample of keys gives the
boundaries of some hundred ranges for each shard: each row of the written table is drawn as often as its
bytes hold whole shares, and once more with the chance of what is left. Bytes of all records are then summed
by range. A range that holds far more than its share (one text with a great many copies) is subdivided by the
records' numbers, so that repeated rows spread too. The exact byte at which each record begins
decides its shard, and counts by range its slot.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from partwise.llm.tables import materialise

RANGES_PER_SHARD = 64
SAMPLES_PER_RANGE = 16
# A range of more than so many times the mean is subdivided.
OVERFULL = 3


def shard_records(
    docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None
) -> DataFrame:
    """The carried columns (default: all) with size, shard and slot.

    size is the UTF-8 bytes of the text (null: none) plus 1. Shards have equal bytes but for less than
    about a twentieth of a shard, mostly far less; equal texts share a shard, unless they are many enough to be an
    overfull range, which may lie over a shard's end. slot counts from 0 without gaps in each shard.
    Ids may be null or repeated; which of wholly equal rows gets which place follows the order of the input.
    A text of any length is one record; no text is held but where its size and hash are taken.
    Carried columns named like a result (size, shard, slot) are left out.
    An empty table gives an empty result.
    """
    spark = docs.sparkSession
    carry = [c for c in (docs.columns if carry is None else carry) if c not in ("size", "shard", "slot")]
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(
        F.struct(*[F.col(c) for c in carry]).alias("record"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.xxhash64(text).alias("key"),
        F.xxhash64(F.col(id_col).cast("string"), F.lit("id")).alias("within"),
        F.monotonically_increasing_id().alias("row"),
    )
    records = materialise(keyed, "records")

    # About so many draws in all, by a hash of the row's number in the written table: repeated rows differ.
    u = F.shiftrightunsigned(F.xxhash64("row", F.lit(7)), 11) / F.lit(float(2**53))
    n_ranges = RANGES_PER_SHARD * shards
    total = records.agg(F.sum("size")).first()[0] or 1
    shares = F.col("size") * (n_ranges * SAMPLES_PER_RANGE / total)
    draws = (F.floor(shares) + (u < shares - F.floor(shares)).cast("bigint")).alias("draws")
    drawn = records.select("key", draws).where("draws > 0").groupBy("key").agg(F.sum("draws").alias("draws")).collect()
    keys = np.array([r["key"] for r in drawn], dtype=np.int64)
    bounds = _bounds(np.sort(np.repeat(keys, np.array([r["draws"] for r in drawn], dtype=np.int64))))

    @F.pandas_udf("int")
    def range_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, key.to_numpy(), side="right").astype(np.int32))

    ranged = records.withColumn("range", range_of("key"))
    held = {r["range"]: r["bytes"] for r in ranged.groupBy("range").agg(F.sum("size").alias("bytes")).collect()}
    share = OVERFULL * max(1, total // n_ranges)
    parts = {r: -(-b // share) for r, b in held.items() if b > share}
    part = F.lit(0)
    if parts:
        of = F.create_map(*[F.lit(x) for pair in parts.items() for x in pair])
        part = F.pmod(F.xxhash64("within", "row"), F.coalesce(of[F.col("range")], F.lit(1)).cast("bigint")).cast("int")
    split = ranged.withColumn("part", part)

    # at most some thousand rows: the ranges and the parts of overfull ones
    sums = split.groupBy("range", "part").agg(F.sum("size").alias("bytes")).collect()
    first, at = [], 0
    for r in sorted(sums, key=lambda r: (r["range"], r["part"])):
        first.append((r["range"], r["part"], at))
        at += r["bytes"]
    starts = spark.createDataFrame(first, "range int, part int, before long")

    order = Window.partitionBy("range", "part").orderBy("key", "within", "row")
    same = Window.partitionBy("range", "part", "key")
    begin = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = split.withColumn("begin", begin)
    # an overfull range may be cut anywhere; elsewhere the middle of all equal texts decides
    whole = ~F.col("range").isin(list(parts)) if parts else F.lit(True)
    middle = F.when(
        whole, F.col("before") + F.min("begin").over(same) + F.sum("size").over(same) / 2
    ).otherwise(F.col("before") + F.col("begin") + F.col("size") / 2)
    shard = F.least(F.floor(middle * shards / max(1, total)), F.lit(shards - 1)).cast("int")
    sharded = placed.join(F.broadcast(starts), ["range", "part"]).withColumn("shard", shard)

    counts = sharded.groupBy("shard", "range", "part").count().collect()
    base, n = [], dict.fromkeys(range(shards), 0)
    for r in sorted(counts, key=lambda r: (r["range"], r["part"])):
        base.append((r["shard"], r["range"], r["part"], n[r["shard"]]))
        n[r["shard"]] += r["count"]
    bases = spark.createDataFrame(base, "shard int, range int, part int, base long")
    own = F.row_number().over(Window.partitionBy("range", "part", "shard").orderBy("key", "within", "row")) - 1
    slotted = sharded.withColumn("own", own).join(F.broadcast(bases), ["shard", "range", "part"])
    return slotted.select("record.*", "size", "shard", (F.col("base") + F.col("own")).alias("slot"))


def _bounds(keys: np.ndarray) -> np.ndarray:
    """Quantiles of the sorted sample; a key drawn often enough to fill a range gets one of its own."""
    values, n = np.unique(keys, return_counts=True)
    hot = values[(n >= SAMPLES_PER_RANGE) & (values < np.iinfo(np.int64).max)]
    return np.unique(np.concatenate([keys[SAMPLES_PER_RANGE::SAMPLES_PER_RANGE], hot, hot + 1]))
