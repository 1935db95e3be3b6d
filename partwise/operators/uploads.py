"""Unfinished and finished uploads: part sizes, completeness, cancelling, latest attempts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from partwise.functions.skew import salted_join
from partwise.limits import MAX_PARTS_PER_UPLOAD


def part_size_histogram(parts: DataFrame) -> DataFrame:
    """(upload_id, size, num_parts), largest size first within an upload when it is shown."""
    return parts.groupBy("upload_id", "size").agg(F.count("*").alias("num_parts"))


def histogram_lists(hist: DataFrame) -> DataFrame:
    """(upload_id, sizes): the histogram nested, sorted by size descending.

    The list of an upload has one entry for each distinct size.
    """
    return hist.groupBy("upload_id").agg(
        F.sort_array(F.collect_list(F.struct("size", "num_parts")), asc=False).alias("sizes")
    )


def largest_part_groups(hist: DataFrame, n: int = 2) -> DataFrame:
    """The n groups of largest parts of each upload, with rank from 1.

    Spark cuts each task's rows down to the first n of an upload before they are shuffled.
    """
    order = Window.partitionBy("upload_id").orderBy(F.desc("size"))
    return (
        hist.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= n)
        .withColumn("rank", F.col("rank").cast("bigint"))
    )


def guess_part_size(parts: DataFrame) -> DataFrame:
    """(upload_id, part_size, ambiguous): the largest size is the part size of an upload.

    It cannot be told when there are more than two sizes, or two and the smaller is not unique.
    """
    return (
        part_size_histogram(parts)
        .groupBy("upload_id")
        .agg(
            F.max("size").alias("part_size"),
            F.count("*").alias("_sizes"),
            F.min_by("num_parts", "size").alias("_smallest"),
        )
        .select(
            "upload_id",
            "part_size",
            ((F.col("_sizes") > 2) | ((F.col("_sizes") == 2) & (F.col("_smallest") != 1))).alias("ambiguous"),
        )
    )


def sanity_check(parts: DataFrame, part_size: Column | int) -> DataFrame:
    """(upload_id, ok_reference, ok_strict, reason): may the upload be completed?

    ok_reference looks at the part sizes only. ok_strict also asks for the part numbers 0 to n-1
    and for the short part to be the last one. part_size is a number or a column of parts that is
    the same for all parts of an upload.
    """
    p = part_size if isinstance(part_size, Column) else F.lit(part_size)
    groups = (
        parts.select("upload_id", "part_num", F.col("size").cast("bigint").alias("size"), p.cast("bigint").alias("_p"))
        .groupBy("upload_id", "size")
        .agg(
            F.count("*").alias("n"),
            F.min("part_num").alias("lo"),
            F.max("part_num").alias("hi"),
            F.max("_p").alias("p"),
        )
    )
    u = groups.groupBy("upload_id").agg(
        F.count("*").alias("sizes"),
        F.sum("n").alias("n"),
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
        F.max("p").alias("p"),
        F.max("size").alias("large"),
        F.min("size").alias("small"),
        F.min_by("n", "size").alias("n_small"),
        F.min_by("hi", "size").alias("hi_small"),
    )
    c = F.col
    full = c("large") == c("p")
    sentinel = (c("large") == 0) & (c("n") == 1)
    one_short = (c("large") > 0) & (c("large") < c("p")) & (c("n") == 1)
    last_short = (c("small") > 0) & (c("small") < c("p")) & (c("n_small") == 1)
    sizes_ok = F.when(c("sizes") == 1, sentinel | full | one_short).otherwise(
        (c("sizes") == 2) & full & last_short
    )
    reason = (
        F.when(c("sizes") > 2, "more than two part sizes")
        .when(~sizes_ok, "part sizes do not fit the part size")
        .when((c("lo") != 0) | (c("hi") != c("n") - 1), "part numbers have a gap")
        .when((c("sizes") == 2) & (c("hi_small") != c("hi")), "the short part is not the last")
    )
    return u.select(
        "upload_id", sizes_ok.alias("ok_reference"), reason.isNull().alias("ok_strict"), reason.alias("reason")
    )


def completion_list(parts: DataFrame, page: int = MAX_PARTS_PER_UPLOAD) -> DataFrame:
    """(upload_id, page, n_parts, parts): what a completion request sends, in part order.

    A page holds as many part numbers as an upload may have parts, so a legal upload is one row. What
    has more is several rows, which in order are its list; no list grows beyond a page.
    """
    number = F.call_function("div", F.col("part_num"), F.lit(page).cast("bigint"))
    return (
        parts.groupBy("upload_id", number.alias("page"))
        .agg(F.array_sort(F.collect_list(F.struct("part_num", "etag"))).alias("parts"))
        .select("upload_id", "page", F.size("parts").cast("bigint").alias("n_parts"), "parts")
    )


def unique_parts(parts: DataFrame) -> DataFrame:
    """(upload_id, part_num, size, etag, reject_reason), one row for each slot.

    A slot that came more than once is one row with reject_reason.
    """
    return (
        parts.groupBy("upload_id", "part_num")
        .agg(F.count("*").alias("_n"), F.min(F.struct("size", "etag")).alias("_part"))
        .select(
            "upload_id",
            "part_num",
            "_part.size",
            "_part.etag",
            F.when(F.col("_n") > 1, F.lit("DuplicatePart")).alias("reject_reason"),
        )
    )


def merge_completed(old: DataFrame, new: DataFrame) -> DataFrame:
    """Parts of the resumed upload and new ones; a part number may not be in both."""
    columns = ["upload_id", "part_num", "size", "etag"]
    return unique_parts(old.select(*columns).unionByName(new.select(*columns)))


def transfer_summary(planned: DataFrame, completed: DataFrame) -> DataFrame:
    """(upload_id, n_parts, n_done, bytes_done, n_missing); slots outside the plan do not count."""
    slots = (
        planned.select("upload_id", "part_num", F.lit(True).alias("_planned"), F.lit(None).cast("bigint").alias("size"))
        .unionByName(
            completed.select(
                "upload_id", "part_num", F.lit(False).alias("_planned"), F.col("size").cast("bigint").alias("size")
            )
        )
        .groupBy("upload_id", "part_num")
        .agg(F.max("_planned").alias("_planned"), F.max("size").alias("size"))
        .filter("_planned")
    )
    return slots.groupBy("upload_id").agg(
        F.count("*").alias("n_parts"),
        F.count("size").alias("n_done"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("bytes_done"),
        F.sum(F.col("size").isNull().cast("bigint")).alias("n_missing"),
    )


def retry_latest(attempts: DataFrame, tie: str = "event_id") -> DataFrame:
    """The last good attempt of each (upload_id, part_num); tie orders equal times.

    Where attempts have a column ok, only those with ok count. max_by is combined before the
    shuffle, so a slot tried very often stays one row for each task.
    """
    if "ok" in attempts.columns:
        attempts = attempts.filter("ok")
    values = [c for c in attempts.columns if c not in ("upload_id", "part_num")]
    return (
        attempts.groupBy("upload_id", "part_num")
        .agg(F.max_by(F.struct(*values), F.struct("recorded_at", tie)).alias("_last"))
        .select("upload_id", "part_num", *[F.col(f"_last.{c}").alias(c) for c in values])
    )


def check_cancel_targets(targets: DataFrame, allow_prefix: bool) -> DataFrame:
    """Add reject_reason: without the flag, a target may not be a whole bucket or folder."""
    bad = (F.col("key") == "") | F.col("key").endswith("/")
    reason = F.lit(None).cast("string") if allow_prefix else F.when(bad, F.lit("InvalidDestinationURL"))
    return targets.withColumn("reject_reason", reason)


def select_cancellable(pending: DataFrame, targets: DataFrame, allow_prefix: bool) -> DataFrame:
    """Unfinished uploads the targets (bucket, key) name; refused targets select nothing.

    Prefixes are matched by equality: a key is cut at each length that occurs among the targets
    of its bucket, and the cut is looked up. No pair of upload and target is compared otherwise.
    """
    usable = (
        check_cancel_targets(targets, allow_prefix)
        .filter(F.col("reject_reason").isNull())
        .select("bucket", "key")
        .distinct()
    )
    if not allow_prefix:
        return salted_join(pending, usable, ["bucket", "key"], ["upload_id"], "left_semi")
    # Keys are at most 1024 bytes, so a bucket has at most that many lengths.
    lengths = (
        usable.select("bucket", F.length("key").alias("_len"))
        .groupBy("bucket")
        .agg(F.collect_set("_len").alias("_lens"))
    )
    cuts = (
        salted_join(pending.select("upload_id", "bucket", "key"), lengths, ["bucket"], ["upload_id"], "inner")
        .withColumn("_len", F.explode("_lens"))
        .filter(F.col("_len") <= F.length("key"))
        .select("upload_id", "bucket", F.substring(F.col("key"), F.lit(1), F.col("_len")).alias("key"))
    )
    hits = salted_join(cuts, usable, ["bucket", "key"], ["upload_id"], "left_semi").select("upload_id").distinct()
    return pending.join(hits, "upload_id", "left_semi")


def reclaim_cancelled(table: DataFrame, cancelled: DataFrame) -> DataFrame:
    """What is left of pending uploads or of their parts once the cancelled ones are gone."""
    gone = cancelled.select("upload_id").distinct()
    if "part_num" not in table.columns:
        return table.join(gone, "upload_id", "left_anti")
    return salted_join(table, gone, ["upload_id"], ["part_num"], "left_anti")
