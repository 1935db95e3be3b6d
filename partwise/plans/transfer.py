"""Files and objects into the store."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partwise.functions.locations import absolute_path, is_path
from partwise.functions.skew import join_by_block
from partwise.limits import MAX_CELL_BYTES, MAX_PART_SIZE
from partwise.operators import policy
from partwise.operators.crypto import attach_keys, derive_object_keys, encrypted, read_keys
from partwise.operators.integrity import composite_etags
from partwise.operators.locations import SOURCE, STORE, classify_locations, derive_destination
from partwise.operators.parts import UPLOAD, n_parts, plan_parts
from partwise.operators.rejects import with_exit_code
from partwise.operators.uploads import sanity_check, unique_parts
from partwise.plans.store import CANCELLED, COMPLETED, Store
from partwise.sources.files import READABLE_SCHEMES
from partwise.sources.objects import fetch_parts, tasks_for
from partwise.sources.scratch import materialise
from partwise.sources.segments import join_cells
from partwise.sources.sinks import bucket_id, file_states

GO = (policy.NEW, policy.RESUME, policy.CANCEL_AND_NEW)
SLOT = ["upload_id", "part_num"]
NO_KEYS = "key_id string, key_text string, is_master boolean"


def _named(requests: DataFrame, base_dir: str) -> DataFrame:
    """Requests with source and destination taken apart, and reject_reason."""
    source = classify_locations(requests, "src_url", SOURCE, base_dir).withColumnsRenamed(
        {"scheme": "src_scheme", "authority": "src_bucket", "path": "src_path", "reject_reason": "_src_reject"}
    )
    both = classify_locations(source.drop("has_query"), "dst_url", STORE).withColumn("key", F.expr("substring(path, 2)"))
    # Only a URL has a query: a plain path is read, and named, as it is; so is the path of a file URL read.
    plain = is_path(F.col("src_url"))
    whole = F.when(plain, absolute_path(F.col("src_url"), base_dir)).otherwise(
        F.regexp_replace("src_url", r"^(?i:file):(//[^/]*)?", "")
    )
    both = both.withColumn("src_path", F.when(plain, whole).otherwise(F.col("src_path")))
    if "dst_key" in requests.columns:  # given as it is, not as part of a URL
        both = both.withColumn("key", F.coalesce("dst_key", "key")).drop("dst_key")
    return derive_destination(both, "key", "src_path").select(
        *[c for c in requests.columns if c != "dst_key"],
        "src_scheme",
        "src_bucket",
        "src_path",
        F.when(F.col("src_scheme") == "file", whole)
        .when(F.col("src_scheme").isin(READABLE_SCHEMES), F.col("src_url"))
        .alias("url"),
        F.col("authority").alias("bucket"),
        F.col("dst_key").alias("key"),
        F.coalesce("reject_reason", "_src_reject").alias("reject_reason"),
    )


def _first_reason(df: DataFrame, reason: Column) -> DataFrame:
    return df.withColumn("reject_reason", F.coalesce(F.col("reject_reason"), reason))


def _without_rivals(asked: DataFrame, on: list[str], error_class: str) -> DataFrame:
    """Of requests for one destination the first; the others fail, as if they came after it."""
    valid = asked.filter(F.col("reject_reason").isNull())
    first = valid.groupBy(*on).agg(F.min("object_id").alias("_first"))
    both = asked.join(first, on, "left")
    return _first_reason(both, F.when(F.col("object_id") != F.col("_first"), F.lit(error_class))).select(*asked.columns)


def _size_reason(part_size: Column) -> Column:
    return F.when(part_size.isNull() | (part_size < 1) | (part_size > MAX_PART_SIZE), F.lit("UserError"))


def _decide(store: Store, asked: DataFrame, run_id: str) -> DataFrame:
    """Materialised requests with action, error_class, exit_code and upload_id.

    The fingerprint of the key stands for the key; keys themselves are in no written table.
    """
    valid = asked.filter(F.col("reject_reason").isNull()).withColumn("key_id", F.col("key_md5_b64"))
    dest = store.objects(valid).withColumn("key_id", F.col("key_md5_b64"))
    pending = store.pending()
    decided = policy.upload_decisions(valid, dest, pending, store.parts_of(pending), on=("bucket", "key"))
    new_id = F.md5(F.concat_ws("/", "bucket", "key", F.lit(run_id)).cast("binary"))
    joined = asked.join(decided, "object_id", "left").select(
        *asked.columns,
        F.when(F.col("reject_reason").isNotNull(), policy.FAIL).otherwise(F.col("action")).alias("action"),
        F.coalesce("reject_reason", "error_class").alias("error_class"),
        F.coalesce("upload_id", new_id).alias("upload_id"),
    )
    return materialise(with_exit_code(joined).drop("reject_reason"), "decisions")


def _open_uploads(store: Store, go: DataFrame) -> None:
    """Cancel what is to make way, then begin what is new."""
    forced = go.filter(F.col("action") == policy.CANCEL_AND_NEW).select("bucket", "key")
    store.close(store.pending().join(forced, ["bucket", "key"], "left_semi"), CANCELLED)
    begun = go.filter(F.col("action") != policy.RESUME)
    store.append("uploads", begun.withColumn("initiated", F.current_timestamp()))


def _publish(store: Store, go: DataFrame) -> None:
    """Complete the uploads among go whose parts are all there."""
    stored = materialise(unique_parts(store.parts_of(go)), "stored")
    sizes = go.select("upload_id", F.col("part_size").alias("_p"), F.col("size").alias("_s"))
    planned = n_parts(F.col("_s"), F.col("_p"), UPLOAD)
    # One row for each upload and block: a huge upload is no hot key when its part size is joined.
    parts = join_by_block(stored, sizes, planned, "inner", "upload_id")
    counts = parts.groupBy("upload_id").agg(
        F.count("*").alias("n"),
        F.sum("size").alias("bytes"),
        F.max("_s").alias("size"),
        F.max(planned).alias("planned"),
        F.count("reject_reason").alias("doubled"),
    )
    whole = (F.col("n") == F.col("planned")) & (F.col("bytes") == F.col("size")) & (F.col("doubled") == 0)
    checked = counts.filter(whole).join(sanity_check(parts, F.col("_p")).filter("ok_strict"), "upload_id")
    etags = composite_etags(
        stored.select(F.col("upload_id").alias("object_id"), "part_num", "size", F.col("etag").alias("md5"))
    ).select(F.col("object_id").alias("upload_id"), "etag")
    finished = materialise(
        go.join(checked.select("upload_id"), "upload_id", "left_semi")
        .join(etags, "upload_id")
        .withColumn("published_at", F.current_timestamp()),
        "finished",
    )
    store.append("objects", finished)
    store.close(finished, COMPLETED)


def _report(store: Store, decided: DataFrame) -> DataFrame:
    """Decisions with size and etag; what was to run and is not published is a failure."""
    published = store.table("objects").select("upload_id", "etag")
    failures = (
        store.index()
        .filter("reject_reason is not null")
        .groupBy("upload_id")
        .agg(F.min("reject_reason").alias("_why"))
    )
    result = decided.join(published, "upload_id", "left").join(failures, "upload_id", "left")
    ran = F.col("action").isin(*GO)
    broken = ran & F.col("etag").isNull()
    return with_exit_code(
        result.select(
            "object_id",
            "bucket",
            "key",
            F.when(broken, policy.FAIL).otherwise(F.col("action")).alias("action"),
            F.when(broken, F.coalesce("_why", F.lit("IncompleteTransfer"))).otherwise(F.col("error_class")).alias("error_class"),
            "size",
            "etag",
        )
    )


# Neighbouring parts that go in the same wave: 2^4.
RUN_BITS = 4


def wave_of(part_num: Column, n: Column, waves: int) -> Column:
    """Wave of a part of an upload of n parts, never earlier than that of a part before it.

    So a short last part is not stored without the full ones, from which the part size of an
    unfinished upload is told. Small uploads are in one wave, huge ones in all.
    """
    runs = F.shiftright(n - 1, RUN_BITS) + 1
    div = lambda a, b: F.call_function("div", a, b)
    step = div(F.shiftright(part_num, RUN_BITS) * waves, runs)
    spare = F.lit(waves - 1) - div((runs - 1) * waves, runs)
    return step + F.pmod(F.xxhash64("upload_id"), spare + 1)


def _ready_in(go: DataFrame, wave: int, waves: int) -> DataFrame:
    n = n_parts(F.col("size"), F.col("part_size"), UPLOAD)
    return go.filter(wave_of(n - 1, n, waves) == wave)


def _keys(spark: SparkSession, keys: DataFrame | None) -> DataFrame:
    return read_keys(keys if keys is not None else spark.createDataFrame([], NO_KEYS))


def _missing(store: Store, go: DataFrame, waves: int) -> DataFrame:
    """Materialised slots still to fill, each with the wave that will fill it."""
    resumed = go.filter(F.col("action") == policy.RESUME)
    asked = go.select("upload_id", "object_id", "url", "size", "part_size")
    planned = plan_parts(asked, F.col("part_size"), UPLOAD, store.spark.sparkContext.defaultParallelism)
    left = planned.join(store.parts_of(resumed).select(*SLOT), SLOT, "left_anti")
    return materialise(
        left.withColumn("wave", wave_of(F.col("part_num"), n_parts(F.col("size"), F.col("part_size"), UPLOAD), waves))
        .withColumn("bucket_id", bucket_id("upload_id")),
        "missing",
    )


def run_transfer(
    store: Store,
    requests: DataFrame,
    keys: DataFrame | None = None,
    base_dir: str = "/",
    waves: int = 1,
    tasks: int | None = None,
) -> DataFrame:
    """Upload files: (object_id, bucket, key, action, error_class, exit_code, size, etag).

    requests: object_id, src_url, dst_url, exists, resume_mode, part_size, key_id, location; dst_key,
    where it is given, is the key in the bucket of dst_url. Of requests for one object the first in
    order of object_id is done, the others end with ObjectExists.
    Each wave is one write, and its complete uploads are published: both are kept when a later one
    fails. The next run, with resume_mode "resume" and exists "skip", goes on from there. Bytes go from the source into the parts table in one pass without shuffle.
    """
    spark = store.spark
    named = materialise(file_states(_named(requests, base_dir), "url", "size"), "named")
    object_keys = derive_object_keys(named, _keys(spark, keys))
    asked = _first_reason(named, F.when(F.col("url").isNull(), F.lit("UnsupportedScheme")))
    asked = _first_reason(asked, F.when(F.col("size").isNull(), F.lit("SourceMissing")))
    asked = asked.join(object_keys.select("object_id", "key_md5_b64", F.col("reject_reason").alias("_key_reject")), "object_id")
    asked = _first_reason(_first_reason(asked, F.col("_key_reject")).drop("_key_reject"), _size_reason(F.col("part_size")))
    asked = _without_rivals(materialise(asked, "checked"), ["bucket", "key"], "ObjectExists")
    asked = materialise(asked, "asked")
    decided = _decide(store, asked, uuid.uuid4().hex)
    go = decided.filter(F.col("action").isin(*GO))
    _open_uploads(store, go)
    missing = _missing(store, go, waves)
    tasks = tasks or -(-tasks_for(missing) // waves)
    secret = None
    if keys is not None:
        go_keys = go.select("object_id", "key_id", "bucket", "key", "location")
        secret = derive_object_keys(go_keys, _keys(spark, keys)).select("object_id", "object_key")
        secret = secret.join(go.select("object_id", "size", "part_size"), "object_id")
    for wave in range(waves):
        ranges = missing.filter(F.col("wave") == wave)
        if secret is not None:  # joined while the rows are small
            ranges = attach_keys(ranges, secret)
        fetched = fetch_parts(ranges, "upload_id", tasks, order=("bucket_id",))
        if secret is None:
            stored = fetched.withColumn("is_encrypted", F.lit(False))
        else:
            stored = fetched.withColumn("bytes", encrypted(F.col("bytes"), F.col("object_key"))).withColumn(
                "is_encrypted", F.col("object_key").isNotNull()
            )
        store.write(stored)
        _publish(store, _ready_in(go, wave, waves))
    return _report(store, decided)


def run_copy(
    store: Store,
    requests: DataFrame,
    keys: DataFrame | None = None,
    src_keys: DataFrame | None = None,
    waves: int = 1,
    cell_bytes: int = MAX_CELL_BYTES,
) -> DataFrame:
    """Copy objects of the store to other keys, under another encryption key if asked.

    requests as for run_transfer with s3:// sources, and src_key_id. Where part size and key stay, the new
    object names the ranges of the old one: no byte is read or written. Otherwise ranges are cut at the new
    borders on paper, and read, opened and written in tasks that have each part's ranges in order; a new part of more than
    cell_bytes is stored in several rows, the last with the digest over them.
    """
    spark = store.spark
    named = _named(requests, "/").withColumn("src_key", F.expr("substring(src_path, 2)"))
    source = store.objects().select(
        F.col("bucket").alias("src_bucket"),
        F.col("key").alias("src_key"),
        F.col("location").alias("src_location"),
        F.col("upload_id").alias("src_upload_id"),
        "size",
        F.col("part_size").alias("src_part_size"),
        F.col("key_md5_b64").alias("src_md5_b64"),
    )
    found = materialise(named.join(source, ["src_bucket", "src_key"], "left"), "found")
    dst_key = derive_object_keys(found, _keys(spark, keys))
    src_key = _source_keys(found, _keys(spark, src_keys))
    checks = dst_key.select("object_id", "key_md5_b64", F.col("reject_reason").alias("_dst_reject")).join(
        src_key.select("object_id", F.col("key_md5_b64").alias("_src_given")), "object_id"
    )
    asked = found.join(checks, "object_id")
    asked = _first_reason(asked, F.when(F.col("src_scheme") != "s3", F.lit("InvalidS3URL")))
    asked = _first_reason(asked, F.when(F.col("src_upload_id").isNull(), F.lit("SourceMissing")))
    asked = _first_reason(asked, F.col("_dst_reject"))
    asked = _first_reason(
        asked, F.when(~F.col("_src_given").eqNullSafe(F.col("src_md5_b64")), F.lit("InvalidEncryptionKey"))
    )
    asked = materialise(_first_reason(asked, _size_reason(F.col("part_size"))).drop("_dst_reject", "_src_given"), "checked")
    asked = materialise(_without_rivals(asked, ["bucket", "key"], "ObjectExists"), "asked")
    run_id = uuid.uuid4().hex
    decided = _decide(store, asked, run_id)
    go = decided.filter(F.col("action").isin(*GO))
    _open_uploads(store, go)
    resumed = go.filter(F.col("action") == policy.RESUME)
    done = materialise(store.parts_of(resumed).select(*SLOT), "done")

    # Parts that keep their borders and their key are entered under the new upload; nothing of them is read.
    same_key = F.col("src_md5_b64").eqNullSafe(F.col("key_md5_b64"))
    sources = materialise(
        go.select(
            F.col("src_upload_id").alias("upload_id"),
            F.col("upload_id").alias("dst_upload_id"),
            F.col("src_part_size").alias("part_size"),
            "size",
            "object_id",
            F.col("part_size").alias("dst_part_size"),
            n_parts(F.col("size"), F.col("part_size"), UPLOAD).alias("dst_parts"),
            (same_key & (F.col("src_part_size") == F.col("part_size"))).alias("by_reference"),
        ),
        "sources",
    )
    has_same, has_other = sources.agg(F.max("by_reference"), F.max(~F.col("by_reference"))).first()
    bucket = bucket_id("upload_id").alias("bucket_id")
    if has_same:
        referred = store.pieces(sources.filter("by_reference"), ["dst_upload_id", "dst_parts"]).select(
            F.col("dst_upload_id").alias("upload_id"), "dst_parts", "part_num", "start", "end", "offset", "n", "md5", "is_encrypted",
            F.lit(None).cast("string").alias("reject_reason"), F.lit(run_id).alias("attempt"), "segment", "position", "stored",
        )
        referred = materialise(referred.join(done, SLOT, "left_anti"), "referred")
    if has_other:
        moving = sources.filter("not by_reference").withColumn("dst_size", F.col("size"))
        carry = ["dst_upload_id", "object_id", "dst_part_size", "dst_parts", "dst_size"]
        planned = store.ranges(moving, carry, F.col("dst_part_size")).withColumn("upload_id", F.col("dst_upload_id"))
        planned = materialise(planned.join(done, SLOT, "left_anti"), "ranges")
        tasks = -(-tasks_for(planned.select(F.col("offset").alias("start"), (F.col("offset") + F.col("n")).alias("end"))) // waves)
        sized = moving.select("object_id", "size", F.col("dst_part_size").alias("part_size"))
        to_keys = dst_key.select("object_id", "object_key").join(sized, "object_id")
        from_keys = src_key.select("object_id", "object_key").join(sized, "object_id")
    for wave in range(waves):
        in_wave = wave_of(F.col("part_num"), F.col("dst_parts"), waves) == wave
        if has_same:
            store.refer(referred.filter(in_wave).select("*", bucket))
        if has_other:
            keyed = attach_keys(planned.filter(in_wave), to_keys).withColumnRenamed("object_key", "_to")
            cells = join_cells(store.opened(keyed, from_keys, tasks), "upload_id", cell_bytes)
            first = F.col("part_num") * F.col("dst_part_size")
            # A part that cannot be opened becomes a reject.
            moved = cells.select(
                "upload_id",
                bucket,
                "part_num",
                first.alias("start"),
                F.least(first + F.col("dst_part_size"), F.col("dst_size")).alias("end"),
                "offset",
                encrypted(F.col("bytes"), F.col("_to")).alias("bytes"),
                "md5",
                F.col("_to").isNotNull().alias("is_encrypted"),
                F.when(F.col("bytes").isNull(), F.lit("InvalidEncryptionKey")).alias("reject_reason"),
                F.lit(run_id).alias("attempt"),
            )
            store.write(moved)
        _publish(store, _ready_in(go, wave, waves))
    return _report(store, decided)


def _source_keys(found: DataFrame, keys: DataFrame) -> DataFrame:
    return derive_object_keys(
        found.select(
            "object_id",
            F.col("src_key_id").alias("key_id"),
            F.col("src_bucket").alias("bucket"),
            F.col("src_key").alias("key"),
            F.col("src_location").alias("location"),
        ),
        keys,
    )
