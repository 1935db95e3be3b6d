"""Objects of the store into files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partwise.functions.skew import salted_join
from partwise.operators import policy
from partwise.operators.crypto import derive_object_keys
from partwise.operators.integrity import VERIFIED, verify_parts
from partwise.operators.locations import FILE, STORE, classify_locations
from partwise.operators.parts import DOWNLOAD, plan_parts
from partwise.operators.rejects import with_exit_code
from partwise.plans.store import Store
from partwise.plans.transfer import _first_reason, _keys, _size_reason, _without_rivals
from partwise.sources import progress as journal
from partwise.sources.objects import digest_ranges, tasks_for
from partwise.sources.scratch import materialise
from partwise.sources.segments import write_file_parts
from partwise.sources.sinks import file_states, publish_files

GO = (policy.NEW, policy.LOAD, policy.RESTART, policy.DISCARD)


def find_objects(store: Store, requests: DataFrame, keys: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """(requests with the object src_url names and reject_reason, keys of the objects)."""
    named = classify_locations(requests, "src_url", STORE).withColumn("key", F.expr("substring(path, 2)"))
    named = named.withColumnRenamed("authority", "bucket").drop("scheme", "path", "has_query")
    stored = store.objects().withColumnsRenamed({"part_size": "src_part_size", "key_md5_b64": "src_md5_b64"})
    found = materialise(named.join(stored, ["bucket", "key"], "left"), "named")
    object_keys = derive_object_keys(found, _keys(store.spark, keys))
    given = object_keys.select("object_id", "key_md5_b64", F.col("reject_reason").alias("_key_reject"))
    found = found.join(given, "object_id")
    found = _first_reason(found, F.when(F.col("upload_id").isNull(), F.lit("SourceMissing")))
    found = _first_reason(found, F.col("_key_reject"))
    found = _first_reason(
        found, F.when(~F.col("key_md5_b64").eqNullSafe(F.col("src_md5_b64")), F.lit("InvalidEncryptionKey"))
    )
    return found.drop("_key_reject", "key_md5_b64", "src_md5_b64"), object_keys.select("object_id", "object_key")


def run_download(
    store: Store,
    requests: DataFrame,
    progress_table: str,
    keys: DataFrame | None = None,
    base_dir: str = "/",
    waves: int = 1,
) -> DataFrame:
    """(object_id, dst_path, action, error_class, exit_code, size, n_fetched, n_kept).

    requests: object_id, src_url, dst_url, file_exists, download_exists, part_size, key_id.
    Files are written in place by all tasks, so the destination is mounted by all executors. Parts
    finished by an earlier run are kept when their bytes still have the recorded MD5, and no byte of them is
    read from the store. Progress belongs to the file: another manifest neither sees nor ends it by using the
    same object_id, and finds it under any object_id for the same file. Parts of any size are cut from the stored ranges without a shuffle of bytes. Of requests for
    one file the first in order of object_id is done, the others end with FileExists.
    """
    spark = store.spark
    journal.create_journal(spark, progress_table)
    journal.compact_if_grown(spark, progress_table)
    found, object_keys = find_objects(store, requests, keys)
    target = classify_locations(found.withColumnRenamed("reject_reason", "_src_reject"), "dst_url", FILE, base_dir)
    asked = target.withColumn("reject_reason", F.coalesce("_src_reject", "reject_reason")).withColumnRenamed("path", "dst_path")
    asked = file_states(asked.drop("_src_reject", "scheme", "authority", "has_query"), "dst_path")
    asked = _first_reason(materialise(asked, "checked"), _size_reason(F.col("part_size")))
    asked = materialise(_without_rivals(asked, ["dst_path"], "FileExists"), "asked")
    valid = asked.filter(F.col("reject_reason").isNull())
    before = asked.filter(F.col("file_size").isNotNull()).select("object_id")
    targets = valid.select("object_id", F.col("dst_path").alias("destination"))
    progress = materialise(journal.load_progress(spark, progress_table, targets), "progress")
    decisions = policy.apply_file_exists_policy(valid, before, progress, valid)
    decided = materialise(
        with_exit_code(
            asked.join(decisions.drop("exit_code"), "object_id", "left").select(
                *[F.col(c) for c in asked.columns if c != "reject_reason"],
                F.when(F.col("reject_reason").isNotNull(), policy.FAIL).otherwise(F.col("action")).alias("action"),
                F.coalesce("reject_reason", "error_class").alias("error_class"),
            )
        ),
        "decisions",
    )
    go = decided.filter(F.col("action").isin(*GO))
    fresh = go.filter(F.col("action") != policy.LOAD).withColumn("destination", F.col("dst_path"))
    journal.begin_progress(fresh, progress_table)

    # What an earlier run wrote, read back from the partial files.
    partial = F.regexp_replace("dst_path", r"([^/]+)$", ".$1.partial")
    loaded = go.filter(F.col("action") == policy.LOAD).select("object_id", "size", "part_size", partial.alias("url"))
    slots = materialise(
        plan_parts(loaded, F.col("part_size"), DOWNLOAD, spark.sparkContext.defaultParallelism).join(
            progress.filter("part_num >= 0").select("object_id", "part_num"), ["object_id", "part_num"], "left_semi"
        ),
        "slots",
    )
    kept = materialise(
        verify_parts(progress, digest_ranges(slots, tasks=tasks_for(slots))).filter(F.col("action") == VERIFIED).select(
            "object_id", "part_num", (F.col("end") - F.col("start")).alias("n")
        ),
        "kept",
    )

    sources = materialise(
        go.select(
            "upload_id", F.col("src_part_size").alias("part_size"), "size", "object_id", "dst_path", "etag",
            F.col("part_size").alias("dst_part_size"),
        ),
        "sources",
    )
    # What is kept leaves the plan before anything is opened; the rest is cut at the borders of the parts asked for.
    planned = store.ranges(sources, ["object_id", "dst_path", "dst_part_size"], F.col("dst_part_size")).filter("n > 0")
    planned = materialise(planned.join(kept, ["object_id", "part_num"], "left_anti"), "ranges")
    tasks = -(-tasks_for(planned.select(F.col("offset").alias("start"), (F.col("offset") + planned["n"]).alias("end"))) // waves)
    keyed = None
    if keys is not None:
        keyed = sources.select("object_id", "size", F.col("dst_part_size").alias("part_size")).join(object_keys, "object_id")
    wave_of = F.pmod(F.xxhash64("object_id", F.shiftright("part_num", 4)), F.lit(waves))
    header = sources.select(
        "object_id", "size", F.col("dst_part_size").alias("part_size"), "etag", F.col("dst_path").alias("destination")
    )
    written = None
    for wave in range(waves):
        opened = store.opened(planned.filter(wave_of == wave), keyed, tasks).filter("bytes is not null")
        done = materialise(write_file_parts(opened), "written")
        whole = done.join(header, "object_id").filter(
            (F.col("offset") == F.col("part_num") * F.col("part_size"))
            & (F.col("n") == F.least(F.col("part_size"), F.col("size") - F.col("offset")))
        )
        journal.journal_progress(whole.select("object_id", "part_size", "etag", "part_num", "md5", "destination"), progress_table)
        written = done if written is None else written.unionByName(done)

    tally = (
        written.select("object_id", "n", F.lit(1).alias("_fetched"))
        .unionByName(kept.select("object_id", "n", F.lit(0).alias("_fetched")))
        .groupBy("object_id")
        .agg(
            F.sum("n").alias("_bytes"),
            F.sum("_fetched").cast("bigint").alias("n_fetched"),
            (F.count("*") - F.sum("_fetched")).alias("n_kept"),
        )
    )
    counted = decided.join(tally, "object_id", "left").withColumn("_bytes", F.coalesce("_bytes", F.lit(0)))
    short = F.col("action").isin(*GO) & (F.col("_bytes") != F.col("size"))
    counted = counted.withColumn("error_class", F.when(short, F.lit("IncompleteTransfer")).otherwise(F.col("error_class")))
    counted = counted.withColumn("action", F.when(short, policy.FAIL).otherwise(F.col("action")))
    after = materialise(file_states(go.select("object_id", "dst_path"), "dst_path"), "after").filter("file_size is not null")
    checked = materialise(policy.recheck_destination(counted, before, after), "checked")
    named = materialise(publish_files(checked.filter(F.col("action").isin(*GO))), "published").filter("published")
    journal.end_progress(named.withColumn("destination", F.col("dst_path")), progress_table)
    lost = F.col("action").isin(*GO) & F.col("_ok").isNull()
    result = checked.join(named.select("object_id", F.lit(True).alias("_ok")), "object_id", "left")
    return with_exit_code(
        result.select(
            "object_id",
            "dst_path",
            F.when(lost, policy.FAIL).otherwise(F.col("action")).alias("action"),
            F.when(lost, F.lit("IncompleteTransfer")).otherwise(F.col("error_class")).alias("error_class"),
            "size",
            F.coalesce("n_fetched", F.lit(0)).alias("n_fetched"),
            F.coalesce("n_kept", F.lit(0)).alias("n_kept"),
        )
    )
