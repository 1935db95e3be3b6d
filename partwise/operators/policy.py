"""What to do with each object: decisions from requests and the state of the destination."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partwise.operators.rejects import with_exit_code
from partwise.operators.uploads import guess_part_size

CONTINUE, SKIP, FAIL = "CONTINUE", "SKIP", "FAIL"
NEW, RESUME, CANCEL_AND_NEW = "NEW", "RESUME", "CANCEL_AND_NEW"
LOAD, RESTART, DISCARD = "LOAD", "RESTART", "DISCARD"


def _decisions(df: DataFrame, decision: Column, kept: list[str]) -> DataFrame:
    """decision is a column of "ACTION" or "FAIL:Class" texts; gives action, error_class, exit_code."""
    parts = df.withColumn("_d", F.split(decision, ":")).select(
        *kept,
        F.col("_d")[0].alias("action"),
        F.try_element_at("_d", F.lit(2)).alias("error_class"),
    )
    return with_exit_code(parts)


def _fail(error_class: str) -> Column:
    return F.lit(f"{FAIL}:{error_class}")


def apply_exists_policy(
    requests: DataFrame, dest: DataFrame, on: tuple[str, ...] = ("object_id",)
) -> DataFrame:
    """(object_id, action, error_class, exit_code): is the destination there, readable, what then?

    requests holds object_id, on, exists and key_id; dest holds on and key_id, at most one row for
    each destination. One stored under another key cannot be read, whatever the policy.
    """
    keys = list(on)
    there = dest.select(*keys, F.struct("key_id").alias("_dest"))
    asked = requests.select(*{"object_id": 0, **dict.fromkeys(keys)}, "exists", "key_id")
    found = asked.join(there, keys, "left")
    decision = (
        F.when(F.col("_dest").isNull(), CONTINUE)
        .when(~F.col("_dest.key_id").eqNullSafe(F.col("key_id")), _fail("InvalidEncryptionKey"))
        .when(F.col("exists") == "overwrite", CONTINUE)
        .when(F.col("exists") == "skip", SKIP)
        .when(F.col("exists").isNull(), _fail("ObjectExists"))
        .otherwise(_fail("UserError"))
    )
    return _decisions(found, decision, ["object_id"])


def resolve_pending(requests: DataFrame, pending: DataFrame, completed: DataFrame) -> DataFrame:
    """(object_id, action, error_class, exit_code, upload_id) from unfinished uploads.

    requests holds object_id, bucket, key, resume_mode and part_size. Unfinished uploads and
    their parts are brought to one row for each key before they meet the requests.
    """
    guessed = guess_part_size(completed)
    state = (
        pending.select("upload_id", "bucket", "key")
        .join(guessed, "upload_id", "left")
        .groupBy("bucket", "key")
        .agg(
            F.count("*").alias("_n"),
            F.min(F.struct("upload_id", F.col("part_size").alias("size"), "ambiguous")).alias("_up"),
        )
    )
    asked = requests.select("object_id", "bucket", "key", "resume_mode", "part_size")
    found = asked.join(state, ["bucket", "key"], "left")
    mode, one = F.col("resume_mode"), F.col("_n") == 1
    decision = (
        F.when(mode.isNotNull() & ~mode.isin("resume", "force"), _fail("UserError"))
        .when(F.col("_n").isNull(), NEW)
        .when(mode == "force", CANCEL_AND_NEW)
        .when(~one, _fail("MultipleUploadsExist"))
        .when(mode.isNull(), _fail("UploadExists"))
        .when(F.col("_up.ambiguous"), _fail("AmbiguousPartSize"))
        .when(F.col("_up.size") != F.col("part_size"), _fail("IncompatiblePartSize"))
        .otherwise(RESUME)
    )
    decided = found.withColumn("_upload_id", F.when(one, F.col("_up.upload_id")))
    result = _decisions(decided, decision, ["object_id", "_upload_id"])
    return result.select(
        "object_id",
        "action",
        "error_class",
        "exit_code",
        F.when(F.col("action") == RESUME, F.col("_upload_id")).alias("upload_id"),
    )


def upload_decisions(
    requests: DataFrame,
    dest: DataFrame,
    pending: DataFrame,
    completed: DataFrame,
    on: tuple[str, ...] = ("object_id",),
) -> DataFrame:
    """Destination first, unfinished uploads only where that does not end the request."""
    first = apply_exists_policy(requests, dest, on)
    second = resolve_pending(requests, pending, completed)
    go_on = F.col("first.action") == CONTINUE
    return (
        first.alias("first")
        .join(second.alias("second"), "object_id")
        .select(
            "object_id",
            *[
                F.when(go_on, F.col(f"second.{c}")).otherwise(F.col(f"first.{c}")).alias(c)
                for c in ("action", "error_class", "exit_code")
            ],
            F.when(go_on, F.col("second.upload_id")).alias("upload_id"),
        )
    )


def progress_headers(progress: DataFrame) -> DataFrame:
    """Part size and etag of each download in progress, the last recorded ones."""
    order = F.col("recorded_at") if "recorded_at" in progress.columns else F.lit(0)
    return (
        progress.groupBy("object_id")
        .agg(F.max_by(F.struct("part_size", "etag"), F.struct(order, F.col("part_size"))).alias("_h"))
        .select("object_id", F.col("_h.part_size").alias("recorded_size"), F.col("_h.etag").alias("recorded_etag"))
    )


def _compat(part_size: Column, etag: Column) -> Column:
    return (
        F.when(F.col("recorded_size") != part_size, _fail("IncompatiblePartSize"))
        .when(F.col("recorded_etag").eqNullSafe(etag), LOAD)
        .otherwise(RESTART)
    )


def check_progress_compat(requests: DataFrame, progress: DataFrame, objects: DataFrame) -> DataFrame:
    """(object_id, action, error_class, exit_code) for the requests that have progress.

    LOAD: the recorded slots can be trusted; RESTART: the object is another one now.
    """
    found = (
        requests.select("object_id", "part_size")
        .join(progress_headers(progress), "object_id")
        .join(objects.select("object_id", "etag"), "object_id", "left")
    )
    return _decisions(found, _compat(F.col("part_size"), F.col("etag")), ["object_id"])


def apply_file_exists_policy(
    requests: DataFrame, dest: DataFrame, progress: DataFrame, objects: DataFrame
) -> DataFrame:
    """(object_id, action, error_class, exit_code): destination file first, then progress.

    requests holds file_exists, download_exists and part_size; objects the current etag.
    """
    found = (
        requests.select("object_id", "file_exists", "download_exists", "part_size")
        .join(dest.select("object_id", F.lit(True).alias("_there")), "object_id", "left")
        .join(progress_headers(progress), "object_id", "left")
        .join(objects.select("object_id", "etag"), "object_id", "left")
    )
    there, exists, mode = F.col("_there").isNotNull(), F.col("file_exists"), F.col("download_exists")
    decision = (
        F.when(there & exists.isNull(), _fail("FileExists"))
        .when(there & (exists == "skip"), SKIP)
        .when(there & (exists != "overwrite"), _fail("UserError"))
        .when(F.col("recorded_size").isNull(), NEW)
        .when(mode.isNull(), _fail("DownloadExists"))
        .when(mode == "discard", DISCARD)
        .when(mode == "resume", _compat(F.col("part_size"), F.col("etag")))
        .otherwise(_fail("UserError"))
    )
    return _decisions(found, decision, ["object_id"])


def recheck_destination(decisions: DataFrame, dest_before: DataFrame, dest_after: DataFrame) -> DataFrame:
    """Decisions again, after the run: a destination that appeared meanwhile is an error.

    decisions holds file_exists; with "overwrite" the file is replaced all the same, and requests
    that did not run stay as they are.
    """
    ids = lambda df: df.select("object_id").distinct()
    late = ids(dest_after).join(ids(dest_before), "object_id", "left_anti").withColumn("_late", F.lit(True))
    ran = ~F.col("action").isin(FAIL, SKIP)
    clash = ran & F.col("_late").isNotNull() & ~F.col("file_exists").eqNullSafe("overwrite")
    checked = decisions.join(late, "object_id", "left")
    kept = [c for c in decisions.columns if c not in ("action", "error_class", "exit_code")]
    return with_exit_code(
        checked.select(
            *kept,
            F.when(clash, FAIL).otherwise(F.col("action")).alias("action"),
            F.when(clash, F.lit("FileExists")).otherwise(F.col("error_class")).alias("error_class"),
        )
    )
