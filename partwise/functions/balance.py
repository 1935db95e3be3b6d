"""Rows that stand for bytes, dealt to tasks by a prefix sum over their sizes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Sums by bucket meet in one task, so their number is fixed; each bucket is sorted by itself.
BUCKETS = 4096

# What a range counts for besides its bytes: opening and seeking.
OPEN_COST = 256 * 1024


def with_task(rows: DataFrame, tasks: int, size: Column, order: Sequence[str], bucket: Column) -> DataFrame:
    """rows with _task, 0 to tasks - 1: each task gets the same share of all sizes, to within one unit.

    Rows that agree in the columns order are one unit and get one task. bucket is BIGINT, the same for all rows
    of a unit, and has at most some thousand values: sizes are summed by bucket, the few sums in the order
    of their numbers, and then within each bucket. rows is read twice and no row passes through the driver.
    """
    weighed = rows.withColumn("_weight", size.cast("bigint")).withColumn("_bucket", bucket)
    sums = weighed.groupBy("_bucket").agg(F.sum("_weight").alias("_sum"))
    before = F.sum("_sum").over(Window.orderBy("_bucket")) - F.col("_sum")
    starts = sums.select("_bucket", before.alias("_before"), F.sum("_sum").over(Window.partitionBy(F.lit(0))).alias("_total"))
    # With the default frame, rows of one unit get one sum.
    upto = F.sum("_weight").over(Window.partitionBy("_bucket").orderBy(*order))
    placed = weighed.withColumn("_upto", upto).join(F.broadcast(starts), "_bucket")
    share = (F.col("_before") + F.col("_upto") - 1) / F.greatest("_total", F.lit(1))
    task = F.greatest(F.least(F.floor(share * tasks), F.lit(tasks - 1)), F.lit(0)).cast("int")
    return placed.withColumn("_task", task).drop("_weight", "_bucket", "_upto", "_before", "_total")


def deal_by_bytes(
    parts: DataFrame, tasks: int, key: str, size: Column, first: Sequence[str] = (), last: Sequence[str] = (), run: int = 4
) -> DataFrame:
    """Part rows without bytes in as many partitions as tasks, of nearly equal bytes.

    The largest has at most a task's share and one part. Rows of one part (key, part_num) stay together, and runs of
    2^run parts mostly. Partitions are sorted by first, key, part_num, last.
    """
    bucket = F.pmod(F.xxhash64(key, F.shiftright("part_num", run)), F.lit(BUCKETS).cast("bigint"))
    placed = with_task(parts, tasks, F.greatest(size, F.lit(0)) + OPEN_COST, [key, "part_num"], bucket)
    dealt = placed.repartitionById(tasks, F.col("_task")).drop("_task")
    return dealt.sortWithinPartitions(*first, key, "part_num", *last)
