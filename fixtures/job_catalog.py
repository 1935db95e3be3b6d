"""Queries for sources, sinks, jobs and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fixtures import jobs
from fixtures.catalog import prefix_targets, query
from fixtures.sql import decision
from fixtures.views import P, Views
from partwise.operators.integrity import object_digests, reconcile
from partwise.operators.parts import DOWNLOAD, missing_parts, plan_parts
from partwise.plans.cancel import run_cancel
from partwise.plans.download import run_download
from partwise.plans.transfer import run_copy, run_transfer
from partwise.plans.verify import run_verify, verify_files
from partwise.sources import progress as journal
from partwise.sources.objects import digest_ranges, fetch_parts, scan_objects
from partwise.sources.part_scan import scan_parts
from partwise.sources.scratch import scratch_path
from partwise.sources.sinks import assemble_objects, publish_files, publish_objects, read_parts, write_parts, write_pieces, write_ranges
from partwise.sources.uploads import read_upload_state
from partwise.streaming.objects import stream_objects
from partwise.streaming.progress import read_state, stream_completion, stream_progress, write_changes

# --- sources and sinks ------------------------------------------------------------------------


@query("scan_objects", "select object_id, size from objects")
def _(v: Views) -> DataFrame:
    listed = scan_objects(v.spark, jobs.published(v, "scan"), "*.txt")
    return listed.select(jobs.object_id().alias("object_id"), "size")


@query("scan_parts", """select object_id, part_num, "start", "end", md5(bytes) as md5 from parts where "end" > 0""")
def _(v: Views) -> DataFrame:
    read = scan_parts(v.spark, jobs.published(v, "parts"), P)
    return read.select(jobs.object_id().alias("object_id"), "part_num", "start", "end", F.md5("bytes").alias("md5"))


@query(
    "fetch_parts",
    """select object_id, part_num, md5(bytes) as md5, md5(bytes) as bytes_md5, cast(null as varchar) as reject_reason
       from parts anti join completed using (object_id, part_num)""",
)
def _(v: Views) -> DataFrame:
    listed = scan_objects(v.spark, jobs.published(v, "fetch")).select(jobs.object_id().alias("object_id"), "url", "size")
    fetched = fetch_parts(missing_parts(plan_parts(listed, P), v.completed()))
    return fetched.select("object_id", "part_num", "md5", F.md5("bytes").alias("bytes_md5"), "reject_reason")


@query("digest_ranges", """select object_id, part_num, sha1(bytes) as sha1 from parts where "end" > 0""")
def _(v: Views) -> DataFrame:
    listed = scan_objects(v.spark, jobs.published(v, "ranges")).select(jobs.object_id().alias("object_id"), "url", "size")
    return digest_ranges(plan_parts(listed, P, DOWNLOAD), algo="sha1").select("object_id", "part_num", "sha1")


@query("verify_files", "select object_id, sha256(content) as digest from objects")
def _(v: Views) -> DataFrame:
    listed = scan_objects(v.spark, jobs.published(v, "verify"))
    return verify_files(listed.select(jobs.object_id().alias("object_id"), "url", "size"), "sha256")


@query(
    "read_upload_state",
    """select fmt, upload_id, part_num, c.size, etag, p.bucket, p.key from pending p left join completed c using (upload_id),
       (values ('parquet'),('json')) f(fmt)""",
)
def _(v: Views) -> DataFrame:
    uploads = v.pending().select(
        F.col("upload_id").alias("UploadId"), F.col("bucket").alias("Bucket"), F.col("key").alias("Key"),
        F.lit("2024-01-01T00:00:00Z").cast("timestamp").alias("Initiated"),
    )
    done = v.completed().select(
        F.col("upload_id").alias("UploadId"), (F.col("part_num") + 1).alias("PartNumber"), F.col("size").alias("Size"),
        F.concat(F.lit('"'), "etag", F.lit('"')).alias("ETag"),
    )
    found = None
    for fmt in ("parquet", "json"):
        folder = scratch_path(v.spark, fmt)
        uploads.write.format(fmt).save(f"{folder}/uploads")
        done.write.format(fmt).save(f"{folder}/parts")
        pending, completed = read_upload_state(v.spark, f"{folder}/uploads", f"{folder}/parts", fmt)
        both = pending.drop("initiated").join(completed, "upload_id", "left").withColumn("fmt", F.lit(fmt))
        found = both if found is None else found.unionByName(both)
    return found


@query("write_parts", """select object_id, part_num, "start", "end", md5(bytes) as md5 from parts""")
def _(v: Views) -> DataFrame:
    out = scratch_path(v.spark, "table")
    write_parts(v.parts(), out)
    write_parts(v.parts(), out)  # a repeated write changes nothing
    return read_parts(v.spark, out).select("object_id", "part_num", "start", "end", F.md5("bytes").alias("md5"))


@query(
    "assemble_objects",
    """with whole as (select object_id, string_agg(hex(bytes), '' order by part_num) as h from turn_parts group by 1),
         cut as (select object_id, h, unnest(range(greatest(1, (length(h) + 5999) // 6000))) as chunk_no from whole)
       select object_id, chunk_no, chunk_no * 3000 as "offset", octet_length(unhex(substr(h, chunk_no * 6000 + 1, 6000))) as size,
         md5(unhex(substr(h, chunk_no * 6000 + 1, 6000))) as md5 from cut""",
)
def _(v: Views) -> DataFrame:
    chunks = assemble_objects(v.turn_parts(), 3000)
    return chunks.select(
        "object_id", "chunk_no", "offset", F.length("content").cast("bigint").alias("size"), F.md5("content").alias("md5")
    )


@query(
    "publish_objects",
    """select object_id, size, count(*) as n_parts, object_id % 20 <> 0 as published,
         case when object_id % 20 = 0 then 'InvalidDestinationURL' end as reject_reason,
         case when object_id % 20 <> 0 then md5(content) end as digest
       from objects join parts using (object_id) group by object_id, size, content""",
)
def _(v: Views) -> DataFrame:
    # One file in twenty asks for a name that is kept for partial files.
    parts = jobs.placed_parts(v, jobs.scratch_folder(v, "publish"))
    reserved = F.col("object_id") % 20 == 0
    asked = parts.withColumn("dst_path", F.when(reserved, F.concat("dst_path", F.lit(".partial"))).otherwise(F.col("dst_path")))
    done = publish_objects(asked)
    digests = verify_files(done.filter("published").select("object_id", F.col("dst_path").alias("url"), "size"))
    return done.join(digests, "object_id", "left").drop("dst_path")


@query("write_ranges", "select object_id, size, true as published, md5(content) as digest from objects")
def _(v: Views) -> DataFrame:
    out = jobs.scratch_folder(v, "copies")
    listed = scan_objects(v.spark, jobs.published(v, "originals")).select(jobs.object_id().alias("object_id"), "url", "size")
    planned = plan_parts(listed.withColumn("dst_path", F.concat(F.lit(out + "/"), "object_id")), P, DOWNLOAD)
    written = jobs.materialise(write_ranges(planned), "written")
    whole = written.groupBy("object_id", "dst_path", "size").agg(F.count("md5").alias("n")).filter("n > 0")
    named = jobs.materialise(publish_files(whole), "named")
    digests = verify_files(named.select("object_id", F.col("dst_path").alias("url"), "size"))
    return named.join(digests, "object_id").select("object_id", "size", "published", "digest")


@query(
    "journal_progress",
    """select object_id, part_num, md5 from (select upload_id as object_id, part_num, md5, row_number() over (
         partition by upload_id, part_num order by recorded_at desc, md5 desc) as rn from attempts where ok) where rn = 1 and object_id % 7 <> 0""",
)
def _(v: Views) -> DataFrame:
    table = scratch_path(v.spark, "journal")
    journal.create_journal(v.spark, table)
    rows = v.attempts().select(
        F.col("upload_id").alias("object_id"), F.lit(P).cast("bigint").alias("part_size"), F.lit("e").alias("etag"),
        "part_num", "md5", "recorded_at", "ok",
    )
    # Failed attempts are no progress; the good ones come in two appends.
    journal.journal_progress(rows.filter("ok and part_num % 2 = 0"), table)
    journal.journal_progress(rows.filter("ok and part_num % 2 = 1"), table)
    # Finished objects have no progress any more.
    journal.end_progress(rows.filter("object_id % 7 = 0").select("object_id").distinct(), table)
    return journal.load_progress(v.spark, table).select("object_id", "part_num", "md5")


@query(
    "compact_progress",
    """select object_id, part_num, md5, cast(case when part_num % 3 = 2 then 'after' else 'before' end as varchar) as snapshot
       from (select upload_id as object_id, part_num, md5, row_number() over (
         partition by upload_id, part_num order by recorded_at desc, md5 desc) as rn from attempts where ok) where rn = 1 and object_id % 7 <> 0""",
)
def _(v: Views) -> DataFrame:
    """A third of the slots comes after the snapshot, and finished objects are not in it."""
    table = scratch_path(v.spark, "journal")
    rows = v.attempts().filter("ok").select(
        F.col("upload_id").alias("object_id"), F.lit(P).cast("bigint").alias("part_size"), F.lit("e").alias("etag"),
        "part_num", "md5", "recorded_at", F.concat(F.lit("/d/"), "upload_id").alias("destination"),
    )
    finished = rows.filter("object_id % 7 = 0")
    journal.journal_progress(rows.filter("part_num % 3 <> 2 or object_id % 7 = 0"), table)
    journal.end_progress(finished.select("object_id", "destination").distinct(), table)
    journal.compact_progress(v.spark, table)
    inside = journal.read_journal(v.spark, table).select("object_id", "part_num").withColumn("snapshot", F.lit("before"))
    journal.journal_progress(rows.filter("part_num % 3 = 2 and object_id % 7 <> 0"), table)
    slots = journal.load_progress(v.spark, table)
    found = slots.join(inside, ["object_id", "part_num"], "left")
    return found.select("object_id", "part_num", "md5", F.coalesce("snapshot", F.lit("after")).alias("snapshot"))


@query(
    "scan_parts_where",
    """select object_id, part_num, "start", "end", md5(bytes) as md5 from parts where "end" > 0 and part_num % 2 = 1 and "end" - "start" > 100""",
)
def _(v: Views) -> DataFrame:
    read = scan_parts(v.spark, jobs.published(v, "parts_where"), P, where='part_num % 2 = 1 and `end` - `start` > 100')
    return read.select(jobs.object_id().alias("object_id"), "part_num", "start", "end", F.md5("bytes").alias("md5"))


# --- jobs -------------------------------------------------------------------------------------

_OWN_PARTS = """(select object_id, part_size, unnest(range(greatest(1, cast(ceil(size/part_size) as bigint)))) as part_num, content
  from {0})"""
_OWN_ETAGS = f"""(select object_id, md5(unhex(string_agg(md5(unhex(substr(hex(content), part_num*part_size*2+1, part_size*2))), ''
  order by part_num))) || '-' || count(*) as etag from {_OWN_PARTS} group by 1)"""


@query(
    "run_transfer",
    f"""with damaged as (select distinct object_id from completed c join part_digests d using (object_id, part_num) where c.size <> d.size),
      asked as (select r.object_id, r.part_size, o.size, content from requests r join objects o using (object_id)),
      final as (select u.object_id, a.size, case when u.outcome = 'RESUME' and d.object_id is not null then 'IncompleteTransfer' else u.outcome end as outcome
        from upload_outcomes u join asked a using (object_id) left join damaged d using (object_id))
    select f.object_id, f.size, {decision("f.outcome").replace("end as integer", "when 'IncompleteTransfer' then 1 end as integer")},
      case when f.outcome in ('NEW', 'RESUME', 'CANCEL_AND_NEW') then e.etag end as etag
    from final f join {_OWN_ETAGS.format("asked")} e on f.object_id = e.object_id""",
)
def _(v: Views) -> DataFrame:
    store = jobs.half_done_store(v, "store")
    done = run_transfer(store, jobs.transfer_requests(v, jobs.published(v, "upload")), v.key_table())
    return done.drop("bucket", "key")


@query(
    "run_copy",
    f"""with asked as (select object_id, size, content, cast(case when object_id % 2 = 0 then 1024 else 1500 end as bigint) as part_size from objects)
    select a.object_id, size, 'NEW' as action, etag, 'MATCH' as status from asked a join {_OWN_ETAGS.format("asked")} e using (object_id)""",
)
def _(v: Views) -> DataFrame:
    store = jobs.full_store(v, "store")
    asked = jobs.store_requests(v).select(
        "object_id",
        "src_url",
        F.concat(F.lit("s3://copies/"), "object_id").alias("dst_url"),
        F.lit(None).cast("string").alias("exists"),
        F.lit(None).cast("string").alias("resume_mode"),
        F.when(F.col("object_id") % 2 == 0, P).otherwise(1500).cast("bigint").alias("part_size"),
        F.lit("kB").alias("key_id"),
        F.lit("").alias("location"),
        F.col("key_id").alias("src_key_id"),
    )
    done = run_copy(store, asked, v.key_table(), v.key_table())
    # What is stored now, opened with the new key, against the documents.
    copies = done.select("object_id", F.concat(F.lit("s3://copies/"), "object_id").alias("src_url"), F.lit("kB").alias("key_id"))
    read = run_verify(store, copies, "md5", v.key_table()).select("object_id", F.col("digest").alias("etag"))
    sized = read.join(done.select("object_id", "size"), "object_id")
    wanted = object_digests(v.objects()).withColumnRenamed("digest", "etag").join(v.manifest().select("object_id", "size"), "object_id")
    return done.select("object_id", "size", "action", "etag").join(reconcile(wanted, sized), "object_id")


@query(
    "run_download",
    f"""with kept as (select p.object_id, count(*) as n from progress p join part_digests d using (object_id, part_num)
        where p.md5 = d.md5 group by 1),
      planned as (select object_id, count(*) as n from parts group by 1)
    select o.object_id, {decision("d.outcome")},
      case when d.outcome in ('NEW','LOAD','RESTART','DISCARD') then n.n - case when d.outcome = 'LOAD' then coalesce(k.n, 0) else 0 end else 0 end as n_fetched,
      case when d.outcome = 'LOAD' then coalesce(k.n, 0) else 0 end as n_kept,
      case when d.outcome in ('NEW','LOAD','RESTART','DISCARD') then md5(content) end as digest
    from objects o join download_outcomes d using (object_id) join planned n using (object_id) left join kept k using (object_id)""",
)
def _(v: Views) -> DataFrame:
    store = jobs.full_store(v, "store")
    folder = jobs.scratch_folder(v, "downloads")
    table = scratch_path(v.spark, "journal")
    journal.create_journal(v.spark, table)
    journal.journal_progress(v.progress(), table)
    # Partial files as an earlier run left them, and files that are already there.
    placed = jobs.placed_parts(v, folder).withColumn("offset", F.col("start"))
    jobs.materialise(write_pieces(placed.join(v.progress().select("object_id").distinct(), "object_id", "left_semi")), "partial")
    there = placed.join(v.dest_before(), "object_id", "left_semi").withColumn("bytes", F.encode(F.lit("old"), "UTF-8"))
    first = there.filter("part_num = 0").withColumn("dst_path", F.concat("dst_path", F.lit(".old")))
    jobs.materialise(write_pieces(first), "old")
    jobs.rename_old(first.select("dst_path"))
    requests = v.download_requests().join(jobs.store_requests(v), "object_id").join(
        v.manifest().select("object_id", F.concat_ws("/", F.lit(folder), "bucket", "key").alias("dst_url")), "object_id"
    )
    done = jobs.materialise(run_download(store, requests, table, v.key_table()), "done")
    ok = done.filter("error_class is null and action <> 'SKIP'")
    digests = verify_files(ok.select("object_id", F.col("dst_path").alias("url"), "size"))
    return done.join(digests, "object_id", "left").drop("dst_path", "size")


@query("run_verify", "select object_id, sha256(content) as digest, cast(null as varchar) as error_class, cast(null as integer) as exit_code from objects")
def _(v: Views) -> DataFrame:
    return run_verify(jobs.full_store(v, "store"), jobs.store_requests(v), "sha256", v.key_table())


_TARGETS = """select distinct bucket, case cast(substr(bucket, 4) as integer) % 4 when 0 then '' when 1 then substr(key, 1, 3)
  when 2 then substr(key, 1, 4) else key end as key from objects where cast(substr(bucket, 4) as integer) % 5 <> 0"""


@query(
    "run_cancel",
    f"""with state as (select upload_id, exists (select 1 from ({_TARGETS}) t where t.bucket = p.bucket and starts_with(p.key, t.key)) as cancelled
        from pending p)
      select upload_id, cancelled, case when cancelled then 0 else count(c.part_num) end as n_parts
      from state left join completed c using (upload_id) group by 1, 2""",
)
def _(v: Views) -> DataFrame:
    store = jobs.half_done_store(v, "store")
    before = jobs.materialise(store.pending().select("upload_id"), "before")
    targets = prefix_targets(v).distinct().select(F.concat(F.lit("s3://"), "bucket", F.lit("/"), "key").alias("dst_url"))
    cancelled, _refused = run_cancel(store, targets, allow_prefix=True)
    store.reclaim()
    counts = store.table("parts").groupBy("upload_id").agg(F.count("*").alias("n_parts"))
    marked = before.join(cancelled.select("upload_id", F.lit(True).alias("cancelled")), "upload_id", "left")
    return marked.join(counts, "upload_id", "left").select(
        "upload_id", F.coalesce("cancelled", F.lit(False)).alias("cancelled"), F.coalesce("n_parts", F.lit(0)).alias("n_parts")
    )


@query(
    "reclaim_segments",
    f"""with state as (select upload_id, exists (select 1 from ({_TARGETS}) t where t.bucket = p.bucket and starts_with(p.key, t.key)) as cancelled
        from pending p), held as (select cancelled, cast(octet_length(bytes) as bigint) as n
          from state join completed c using (upload_id) join parts p on p.object_id = c.object_id and p.part_num = c.part_num)
      select cast(coalesce(sum(n) filter (cancelled), 0) as bigint) as bytes_freed,
        cast(coalesce(sum(n) filter (not cancelled), 0) as bigint) as bytes_live from held""",
)
def _(v: Views) -> DataFrame:
    store = jobs.half_done_store(v, "store")
    targets = prefix_targets(v).distinct().select(F.concat(F.lit("s3://"), "bucket", F.lit("/"), "key").alias("dst_url"))
    run_cancel(store, targets, allow_prefix=True)
    return store.reclaim(least_live=1.0).select("bytes_freed", "bytes_live")


@query(
    "copy_by_reference",
    f"""select a.object_id, size, 'NEW' as action, etag, md5(content) as digest, cast(0 as bigint) as bytes_written
        from objects a join {_OWN_ETAGS.format("(select object_id, size, content, 1024::bigint as part_size from objects)")} e using (object_id)""",
)
def _(v: Views) -> DataFrame:
    store = jobs.full_store(v, "store")
    plain = jobs.store_requests(v).select(
        "object_id", "src_url", F.concat(F.lit("s3://copies/"), "object_id").alias("dst_url"), F.lit(None).cast("string").alias("exists"),
        F.lit(None).cast("string").alias("resume_mode"), F.lit(P).cast("bigint").alias("part_size"),
        F.lit(None).cast("string").alias("key_id"), F.lit("").alias("location"),
    )
    # A first copy takes the keys off; the second one keeps part sizes and lack of a key.
    run_copy(store, plain.withColumn("dst_url", F.concat(F.lit("s3://plain/"), "object_id")).join(
        jobs.store_requests(v).select("object_id", F.col("key_id").alias("src_key_id")), "object_id"), None, v.key_table())
    before = store.bytes_held()
    again = plain.withColumn("src_url", F.concat(F.lit("s3://plain/"), "object_id")).withColumn("src_key_id", F.lit(None).cast("string"))
    done = run_copy(store, again)
    read = run_verify(store, done.select("object_id", F.concat(F.lit("s3://copies/"), "object_id").alias("src_url"), F.lit(None).cast("string").alias("key_id")))
    return done.select("object_id", "size", "action", "etag").join(read.select("object_id", "digest"), "object_id").withColumn(
        "bytes_written", F.lit(store.bytes_held() - before).cast("bigint")
    )


# --- streams ----------------------------------------------------------------------------------


@query("stream_objects", "select object_id, etag, size from etags")
def _(v: Views) -> DataFrame:
    store = jobs.Store(v.spark, scratch_path(v.spark, "store")).create()
    folder = jobs.published(v, "incoming")
    jobs.run_to_end(stream_objects(store, folder, "s3://in/", scratch_path(v.spark, "ckpt"), part_size=P))
    return store.objects().select(jobs.object_id("key").alias("object_id"), "etag", "size")


@query(
    "stream_progress",
    f"""select upload_id, count(distinct part_num) as n_done, cast(count(distinct part_num) * {P} as bigint) as bytes_done
        from attempts where ok group by 1""",
)
def _(v: Views) -> DataFrame:
    out = scratch_path(v.spark, "state")
    jobs.run_to_end(write_changes(stream_progress(jobs.event_stream(v)), out, scratch_path(v.spark, "ckpt")))
    return read_state(v.spark, out, "upload_id bigint, n_done bigint, bytes_done bigint")


_PLANS = "select distinct upload_id, 1 + upload_id % 4 as n_parts from attempts"


@query(
    "stream_completion",
    f"""select upload_id, n_parts from (select p.upload_id, p.n_parts, count(distinct a.part_num) as n from ({_PLANS}) p
        join attempts a using (upload_id) where ok and a.part_num < p.n_parts group by 1, 2) where n = n_parts""",
)
def _(v: Views) -> DataFrame:
    plans = v.attempts().select("upload_id", (F.lit(1) + F.col("upload_id") % 4).alias("n_parts")).distinct()
    out = scratch_path(v.spark, "state")
    done = stream_completion(jobs.event_stream(v), jobs.materialise(plans, "plans"))
    jobs.run_to_end(write_changes(done, out, scratch_path(v.spark, "ckpt")))
    return v.spark.read.schema("upload_id bigint, n_parts bigint").parquet(out + "/*")
