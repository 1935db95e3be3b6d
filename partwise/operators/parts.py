"""Objects into byte ranges, and what is left to do of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partwise.functions.skew import join_by_block
from partwise.limits import BLOCK_BITS, BLOCK_PARTS, MAX_PART_SIZE, MAX_PARTS_PER_UPLOAD, MIN_PART_SIZE

UPLOAD, DOWNLOAD = "upload", "download"
PART_KEY = ["object_id", "part_num"]


def ceil_div(size: Column, part_size: Column | int) -> Column:
    """Exact for every BIGINT: the division is not done on doubles."""
    p = part_size if isinstance(part_size, Column) else F.lit(part_size).cast("bigint")
    return F.call_function("div", size, p) + F.when(size % p > 0, 1).otherwise(0).cast("bigint")


def n_parts(size: Column, part_size: Column | int, mode: str = UPLOAD) -> Column:
    """An empty object is one empty part on upload and no part on download."""
    if mode not in (UPLOAD, DOWNLOAD):
        raise ValueError(f"unknown mode {mode!r}")
    count = ceil_div(size, part_size)
    return F.greatest(count, F.lit(1).cast("bigint")) if mode == UPLOAD else count


def _range(last: Column) -> Column:
    return F.sequence(F.lit(0).cast("bigint"), last)


def plan_parts(
    objects: DataFrame, part_size: Column | int, mode: str = UPLOAD, tasks: int | None = None
) -> DataFrame:
    """One row for each part: the columns of objects without content, and part_num, start, end.

    part_size is a number or a column of objects. Part numbers are made in two steps, blocks and
    parts of a block, so that no array grows with the size of an object. With tasks, the blocks
    are dealt to that many tasks in between, and those of a huge object are numbered by many;
    without it nothing is shuffled.
    """
    p = part_size if isinstance(part_size, Column) else F.lit(part_size).cast("bigint")
    kept = [c for c in objects.columns if c != "content"]
    counted = objects.select(*kept, p.alias("_p"), n_parts(F.col("size"), p, mode).alias("_n"))
    blocks = counted.filter("_n > 0").withColumn(
        "_block", F.explode(_range(F.shiftright(F.col("_n") - 1, BLOCK_BITS)))
    )
    if tasks is not None:
        blocks = blocks.repartition(tasks)
    first = F.shiftleft(F.col("_block"), BLOCK_BITS)
    numbered = blocks.withColumn(
        "part_num", F.explode(F.sequence(first, F.least(first + (BLOCK_PARTS - 1), F.col("_n") - 1)))
    )
    start = F.col("part_num") * F.col("_p")
    # size - start cannot overflow, start + P can.
    return numbered.select(
        *kept,
        "part_num",
        start.alias("start"),
        (start + F.least(F.col("_p"), F.col("size") - start)).alias("end"),
    )


def split_parts(objects: DataFrame, part_size: int) -> DataFrame:
    """plan_parts for objects that hold their content, with the bytes of each part.

    The content fits one cell, so its parts fit one array of numbers.
    """
    kept = [c for c in objects.columns if c not in ("content", "size")]
    size = F.length("content").cast("bigint")
    numbered = objects.select(
        *kept, "content", F.explode(_range(n_parts(size, part_size) - 1)).alias("part_num")
    )
    start = F.col("part_num") * part_size
    return numbered.select(
        *kept,
        "part_num",
        start.alias("start"),
        F.least(start + part_size, F.length("content").cast("bigint")).alias("end"),
        F.substring(F.col("content"), (start + 1).cast("int"), F.lit(part_size)).alias("bytes"),
    )


def drop_empty_parts(parts: DataFrame) -> DataFrame:
    """A part without bytes is kept only as the first one."""
    return parts.filter("size > 0 OR part_num = 0")


def stop_at_short_part(parts: DataFrame, part_size: int) -> DataFrame:
    """Parts of objects of unknown length up to the first short one.

    A part longer than part_size gets reject_reason and is kept. The end of an object is repeated
    once for each block of its parts, so a long object is no hot key of the join.
    """
    ends = parts.groupBy("object_id").agg(
        F.min(F.when(F.col("size") < part_size, F.col("part_num"))).alias("_eof"),
        F.max("part_num").alias("_last"),
    )
    return (
        join_by_block(parts, ends, F.col("_last") + 1)
        .filter(F.col("_eof").isNull() | (F.col("part_num") <= F.col("_eof")))
        .drop("_eof", "_last")
        .withColumn("reject_reason", F.when(F.col("size") > part_size, F.lit("PartTooLong")))
    )


def missing_parts(planned: DataFrame, completed: DataFrame, key: list[str] = PART_KEY) -> DataFrame:
    return planned.join(completed.select(*key), key, "left_anti")


def completed_parts_for_resume(
    planned: DataFrame, completed: DataFrame, key: list[str] = PART_KEY
) -> DataFrame:
    return planned.join(completed.select(*key), key, "left_semi")


def plan_capacity(
    objects: DataFrame, part_size: int, download_slots: int, upload_slots: int
) -> DataFrame:
    """Add n_parts, over_limit, min_part_size, buffer_bytes and reject_reason.

    min_part_size is the least allowed part size that keeps the object within the part limit;
    an object no allowed part size can hold is rejected. buffer_bytes is the least memory all
    slots need together.
    """
    count = n_parts(F.col("size"), part_size)
    least = F.greatest(F.lit(MIN_PART_SIZE).cast("bigint"), ceil_div(F.col("size"), MAX_PARTS_PER_UPLOAD))
    return objects.select(
        *[c for c in objects.columns if c != "content"],
        count.alias("n_parts"),
        (count > MAX_PARTS_PER_UPLOAD).alias("over_limit"),
        F.when(least <= MAX_PART_SIZE, least).alias("min_part_size"),
        F.lit((download_slots + upload_slots) * part_size).cast("bigint").alias("buffer_bytes"),
        F.when(least > MAX_PART_SIZE, F.lit("UserError")).alias("reject_reason"),
    )


def cut_at_borders(parts: DataFrame, part_size: Column | int) -> DataFrame:
    """Cut parts that hold bytes at multiples of part_size: (object_id, part_num, start, end, bytes).

    Every old part gives one piece for each new part it touches. part_size is a number or a column
    that is the same for all parts of an object.
    """
    p = part_size if isinstance(part_size, Column) else F.lit(part_size)
    old = parts.select("object_id", "start", "end", "bytes", p.cast("bigint").alias("_p"))
    first = F.call_function("div", F.col("start"), F.col("_p"))
    last = F.call_function("div", F.greatest(F.col("end") - 1, F.col("start")), F.col("_p"))
    pieces = old.withColumn("part_num", F.explode(F.sequence(first, last)))
    low = F.greatest(F.col("start"), F.col("part_num") * F.col("_p"))
    high = F.least(F.col("end"), (F.col("part_num") + 1) * F.col("_p"))
    return pieces.select(
        "object_id",
        "part_num",
        low.alias("start"),
        high.alias("end"),
        F.substring(
            F.col("bytes"), (low - F.col("start") + 1).cast("int"), (high - low).cast("int")
        ).alias("bytes"),
    )


def resplit_parts(parts: DataFrame, part_size: Column | int) -> DataFrame:
    """Parts of another size: cut_at_borders, and the pieces of each new part joined in order.

    A new part is one cell and no group passes it.
    """
    return cut_at_borders(parts, part_size).groupBy("object_id", "part_num").agg(
        F.min("start").alias("start"),
        F.max("end").alias("end"),
        joined_bytes(F.collect_list(F.struct("start", "bytes"))).alias("bytes"),
    )


def joined_bytes(pieces: Column) -> Column:
    """One BINARY from an array of structs (order, bytes), in time linear in its length."""
    texts = F.transform(F.array_sort(pieces), lambda piece: F.hex(piece["bytes"]))
    return F.unhex(F.array_join(texts, ""))
