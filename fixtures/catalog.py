"""Every operator as a query over the given tables, with the SQL it has to agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fixtures.sql import LINE_P, P, SYMBOL_SQL, code, decision, with_views
from fixtures.views import LINE_P as LINE_PART
from fixtures.views import Views
from partwise.operators import crypto, integrity, locations, parts, policy, rejects, sizes, uploads

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[Views], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(Views(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = with_views(sql)
        return build

    return register


# --- locations, sizes -------------------------------------------------------------------------

_URL_SQL = r"'^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)'"


@query(
    "classify_locations",
    rf"""with asked as (
        select *, raw like '/%' or raw like '.%' or raw not like '%:%' as is_path,
          list_transform(list_filter(string_split(case when raw like '/%' then raw else '/base/' || raw end, '/'),
            lambda s: s not in ('', '.')), lambda s: [s]) as segments
        from locations, (values ('source'),('store'),('file')) r(role)),
      urls as (
        select *, case when role = 'store' or not is_path then raw else 'file:///' || array_to_string(
          list_reduce(segments, lambda acc, s: case when s[1] = '..' then acc[:-2] else list_concat(acc, s) end, []::varchar[]), '/') end as url
        from asked),
      cut as (
        select *, lower(regexp_extract(url, {_URL_SQL}, 1)) as scheme, regexp_extract(url, {_URL_SQL}, 2) as authority,
          regexp_extract(url, {_URL_SQL}, 3) as full_path from urls),
      done as (
        select id, raw, role, scheme, authority, regexp_matches(url, '[?#]') as has_query,
          case when scheme in ('ftp','hdl','prospero','http','imap','https','shttp','rtsp','rtsps','rtspu','sip','sips','mms','sftp','tel') then regexp_replace(full_path, ';[^/]*$', '') else full_path end as path
        from cut)
    select id, raw, role, scheme, authority, path, has_query,
      case when role <> 'store' and scheme = 'file' and authority not in ('', 'localhost') then 'InvalidSourceURL'
        when (role = 'store' or (role = 'source' and scheme = 's3'))
          and (scheme <> 's3' or authority = '' or path not like '/%') then 'InvalidS3URL'
        when role = 'file' and (scheme <> 'file' or regexp_matches(path, '\.(partial|progress)$')) then 'InvalidDestinationURL'
      end as reject_reason from done""",
)
def _(v: Views) -> DataFrame:
    found = None
    for role in (locations.SOURCE, locations.STORE, locations.FILE):
        one = locations.classify_locations(v.locations().withColumn("role", F.lit(role)), "raw", role, "/base")
        found = one if found is None else found.unionByName(one)
    return found


@query(
    "derive_destination",
    """select object_id, prefix, prefix || case when prefix = '' or prefix like '%/' then
         regexp_extract('/in/' || key, '([^/]*)$', 1) else '' end as dst_key
       from (select object_id, key, case object_id % 3 when 0 then '' when 1 then bucket || '/' else key end as prefix from objects)""",
)
def _(v: Views) -> DataFrame:
    oid = F.col("object_id")
    prefix = F.when(oid % 3 == 0, "").when(oid % 3 == 1, F.concat("bucket", F.lit("/"))).otherwise(F.col("key"))
    asked = v.manifest().select("object_id", prefix.alias("prefix"), F.concat(F.lit("/in/"), "key").alias("path"))
    return locations.derive_destination(asked, "prefix").drop("path")


@query(
    "resolve_region",
    """select object_id, location, case location when '' then 'us-east-1' else location end as region,
         case when location = '' then 'https://s3.amazonaws.com' else 'https://s3-' || location || '.amazonaws.com' end as base_url,
         case when location is null then 'PermissionDenied' end as reject_reason, location as back
       from (select object_id, case when object_id % 10 <> 0 then location end as location from objects)""",
)
def _(v: Views) -> DataFrame:
    known = v.manifest().select("object_id", F.when(F.col("object_id") % 10 != 0, F.col("location")).alias("location"))
    named = locations.resolve_region(known)
    back = locations.bucket_locations(named.withColumnRenamed("location", "_l")).withColumnRenamed("location", "back")
    return back.withColumnRenamed("_l", "location")


def _sizes_sql(reject: str) -> str:
    return f"""select raw, bytes, case when bytes is null or {reject} then 'UserError' end as reject_reason
      from (select raw, case when value < 9223372036854775808 then cast(floor(value) as bigint) end as bytes
        from (select raw, try_cast(regexp_extract(raw, '^([0-9.]*)', 1) as double) * factor as value
          from size_texts left join ({SYMBOL_SQL}) u
            on u.unit = regexp_replace(regexp_replace(raw, '^[0-9.]*\\s*', ''), '\\s+$', '')))"""


@query("normalise_sizes", _sizes_sql("bytes < 5242880 or bytes > 5368709120"))
def _(v: Views) -> DataFrame:
    return sizes.normalise_sizes(v.size_texts(), "raw")


@query("normalise_sizes_download", _sizes_sql("bytes < 1"))
def _(v: Views) -> DataFrame:
    return sizes.normalise_sizes(v.size_texts(), "raw", lo=1, hi=None)


@query(
    "size_report",
    """select bucket, object_id, count(*) as n_parts, cast(sum("end"-"start") as bigint) as bytes,
         case when sum("end"-"start") >= 1048576 then printf('%.1f M', sum("end"-"start")/1048576.0)
              when sum("end"-"start") >= 1024 then printf('%.1f K', sum("end"-"start")/1024.0)
              else printf('%.1f ', sum("end"-"start")/1.0) end as human
       from parts join (select object_id, bucket from objects) using (object_id) group by grouping sets ((bucket, object_id), (bucket))""",
)
def _(v: Views) -> DataFrame:
    planned = parts.plan_parts(v.objects(), P).withColumn("size", F.col("end") - F.col("start"))
    each = sizes.size_report(planned, ["bucket", "object_id"])
    total = sizes.size_report(planned, ["bucket"]).withColumn("object_id", F.lit(None).cast("bigint"))
    return each.unionByName(total)


# --- parts ------------------------------------------------------------------------------------


@query(
    "plan_parts",
    f"""select object_id, cast('upload' as varchar) as mode, part_num, "start", "end" from parts
        union all select object_id, 'download', part_num, "start", "end" from parts where "end" > 0
        union all select object_id + 1000000, 'upload', 0, 0, 0 from objects""",
)
def _(v: Views) -> DataFrame:
    objects = v.manifest().select("object_id", "size")
    # Each object also has an empty sibling: one part on upload, none on download.
    empty = objects.select((F.col("object_id") + 1000000).alias("object_id"), F.lit(0).cast("bigint").alias("size"))
    both = objects.unionByName(empty)
    up = parts.plan_parts(both, P, parts.UPLOAD).withColumn("mode", F.lit("upload"))
    down = parts.plan_parts(both, P, parts.DOWNLOAD).withColumn("mode", F.lit("download"))
    return up.unionByName(down).drop("size")


@query("split_parts", """select object_id, part_num, "start", "end", md5(bytes) as md5 from parts""")
def _(v: Views) -> DataFrame:
    return v.parts().withColumn("md5", F.md5("bytes")).drop("bytes")


@query(
    "drop_empty_parts",
    """select upload_id, part_num, size from (select upload_id, part_num, case when part_num % 3 = 0 then 0 else size end as size
       from all_line_parts) where size > 0 or part_num = 0""",
)
def _(v: Views) -> DataFrame:
    some = v.all_line_parts().withColumn("size", F.when(F.col("part_num") % 3 == 0, 0).otherwise(F.col("size")).cast("bigint"))
    return parts.drop_empty_parts(some)


@query(
    "stop_at_short_part",
    f"""select l.upload_id as object_id, part_num, size, case when size > {LINE_P - 1} then 'PartTooLong' end as reject_reason
        from all_line_parts l left join (select upload_id, min(part_num) as eof from all_line_parts where size < {LINE_P - 1} group by 1) e
          on l.upload_id = e.upload_id where eof is null or part_num <= eof""",
)
def _(v: Views) -> DataFrame:
    return parts.stop_at_short_part(v.all_line_parts().withColumnRenamed("upload_id", "object_id"), LINE_PART - 1)


@query(
    "plan_capacity",
    """select object_id, size, greatest(1, cast(ceil(size/5242880.0) as bigint)) as n_parts,
         greatest(1, cast(ceil(size/5242880.0) as bigint)) > 10000 as over_limit,
         case when greatest(5242880, cast(ceil(size/10000.0) as bigint)) <= 5368709120
           then greatest(5242880, cast(ceil(size/10000.0) as bigint)) end as min_part_size,
         cast(80 * 5242880 as bigint) as buffer_bytes,
         case when greatest(5242880, cast(ceil(size/10000.0) as bigint)) > 5368709120 then 'UserError' end as reject_reason
       from (select object_id, cast(size * size * size * 5 as bigint) as size from objects)""",
)
def _(v: Views) -> DataFrame:
    # Document lengths cubed reach from bytes to petabytes.
    size = F.col("size")
    return parts.plan_capacity(v.manifest().select("object_id", (size * size * size * 5).alias("size")), 5 * 1024**2, 40, 40)


_PLANNED = """select object_id, part_num, "start", "end" from parts p {} join completed c using (object_id, part_num)"""


@query("missing_parts", _PLANNED.format("anti"))
def _(v: Views) -> DataFrame:
    return parts.missing_parts(parts.plan_parts(v.manifest().select("object_id", "size"), P), v.completed()).drop("size")


@query("completed_parts_for_resume", _PLANNED.format("semi"))
def _(v: Views) -> DataFrame:
    planned = parts.plan_parts(v.manifest().select("object_id", "size"), P)
    return parts.completed_parts_for_resume(planned, v.completed()).drop("size")


@query(
    "resplit_parts",
    f"""select object_id, part_num, part_num*1500 as "start", least(part_num*1500+1500, size) as "end",
          md5(unhex(substr(hex(content), part_num*3000+1, 3000))) as md5
        from (select *, unnest(range(greatest(1, cast(ceil(size/1500.0) as bigint)))) as part_num from objects)""",
)
def _(v: Views) -> DataFrame:
    return parts.resplit_parts(v.parts(), 1500).withColumn("md5", F.md5("bytes")).drop("bytes")


# --- integrity --------------------------------------------------------------------------------


@query("part_digests", "select * from part_digests")
def _(v: Views) -> DataFrame:
    return v.part_digests()


@query("part_digests_sha256", """select object_id, part_num, "end"-"start" as size, sha256(bytes) as sha256 from parts""")
def _(v: Views) -> DataFrame:
    return integrity.part_digests(v.parts(), "sha256")


@query("object_digests", "select object_id, md5(content) as digest from objects")
def _(v: Views) -> DataFrame:
    return integrity.object_digests(v.objects())


@query("object_digests_folded", "select object_id, sha1(content) as digest from objects")
def _(v: Views) -> DataFrame:
    return integrity.object_digests(v.parts(), "sha1")


@query("composite_etags", "select * from etags")
def _(v: Views) -> DataFrame:
    return v.etags()


@query(
    "reconcile",
    """select coalesce(s.object_id, d.object_id) as object_id, case when d.object_id is null then 'MISSING_AT_DEST'
         when s.object_id is null then 'EXTRA_AT_DEST' when s.etag = d.etag and s.size = d.size then 'MATCH' else 'DIFFERENT' end as status
       from etags s full join dest d on s.object_id = d.object_id""",
)
def _(v: Views) -> DataFrame:
    return integrity.reconcile(v.etags(), v.dest())


@query(
    "verify_parts",
    """select d.*, case when p.md5 is null then 'DOWNLOAD' when p.md5 = d.md5 then 'VERIFIED' else 'REDOWNLOAD' end as action
       from part_digests d left join (select object_id, part_num, md5 from progress where md5 <> repeat('0',32)) p using (object_id, part_num)""",
)
def _(v: Views) -> DataFrame:
    return integrity.verify_parts(v.progress(), v.part_digests())


@query(
    "byte_entropy",
    """select object_id, cast(sum(n) as bigint) as size, round(log2(sum(n)) - sum(n * log2(n)) / sum(n), 6) as entropy
       from (select object_id, b, cast(count(*) as double) as n from (select object_id, substr(h, cast(i*2+1 as bigint), 2) as b
         from (select object_id, hex(bytes) as h, unnest(range("end"-"start")) as i from parts)) group by 1, 2) group by object_id""",
)
def _(v: Views) -> DataFrame:
    return integrity.byte_entropy(v.objects())


# --- uploads ----------------------------------------------------------------------------------


@query("part_size_histogram", "select * from hist")
def _(v: Views) -> DataFrame:
    return uploads.part_size_histogram(v.line_parts())


@query(
    "largest_part_groups",
    """select * from (select *, row_number() over (partition by upload_id order by size desc) as rank from hist) where rank <= 2""",
)
def _(v: Views) -> DataFrame:
    return uploads.largest_part_groups(uploads.part_size_histogram(v.line_parts()))


@query(
    "histogram_lists",
    "select upload_id, string_agg(size || 'x' || num_parts, ' ' order by size desc) as sizes from hist group by 1",
)
def _(v: Views) -> DataFrame:
    lists = uploads.histogram_lists(uploads.part_size_histogram(v.line_parts()))
    shown = F.transform("sizes", lambda s: F.concat(s["size"], F.lit("x"), s["num_parts"]))
    return lists.select("upload_id", F.array_join(shown, " ").alias("sizes"))


@query(
    "guess_part_size",
    """select upload_id, max(size) as part_size, count(*) > 2 or (count(*) = 2 and arg_min(num_parts, size) <> 1) as ambiguous
       from hist group by 1""",
)
def _(v: Views) -> DataFrame:
    return uploads.guess_part_size(v.line_parts())


_SANITY = f"""
  select upload_id, ok as ok_reference, ok and lo = 0 and hi = n - 1 and (sizes = 1 or hi_small = hi) as ok_strict,
    case when sizes > 2 then 'more than two part sizes' when not ok then 'part sizes do not fit the part size'
      when lo <> 0 or hi <> n - 1 then 'part numbers have a gap'
      when sizes = 2 and hi_small <> hi then 'the short part is not the last' end as reason
  from (select *, case sizes when 1 then (large = 0 and n = 1) or large = {LINE_P} or (large > 0 and large < {LINE_P} and n = 1)
        when 2 then large = {LINE_P} and small > 0 and n_small = 1 else false end as ok
    from (select upload_id, count(distinct size) as sizes, count(*) as n, min(part_num) as lo, max(part_num) as hi,
            max(size) as large, min(size) as small, count(*) filter (where size = s) as n_small, max(part_num) filter (where size = s) as hi_small
          from line_parts join (select upload_id, min(size) as s from line_parts group by 1) using (upload_id) group by 1))"""


@query("sanity_check", _SANITY)
def _(v: Views) -> DataFrame:
    return uploads.sanity_check(v.line_parts(), LINE_PART)


@query(
    "completion_list",
    """select upload_id, part_num // 10000 as page, count(*) as n_parts,
         string_agg(part_num || ':' || etag, ',' order by part_num) as parts
       from (select upload_id, part_num, etag from completed
             union all select 'l' || upload_id, part_num, md5(cast(size as varchar)) from line_parts) group by 1, 2""",
)
def _(v: Views) -> DataFrame:
    lines = v.line_parts().select(
        F.concat(F.lit("l"), "upload_id").alias("upload_id"), "part_num", F.md5(F.col("size").cast("string").cast("binary")).alias("etag")
    )
    pages = uploads.completion_list(v.completed().select("upload_id", "part_num", "etag").unionByName(lines))
    shown = F.transform("parts", lambda p: F.concat(p["part_num"], F.lit(":"), p["etag"]))
    return pages.withColumn("parts", F.array_join(shown, ","))


@query(
    "merge_completed",
    """select upload_id, part_num, min(size) as size, md5(cast(min(size) as varchar)) as etag, case when count(*) > 1 then 'DuplicatePart' end as reject_reason
       from (select * from line_parts union all select * from all_line_parts) group by 1, 2""",
)
def _(v: Views) -> DataFrame:
    tagged = lambda df: df.withColumn("etag", F.md5(F.col("size").cast("string").cast("binary")))
    return uploads.merge_completed(tagged(v.line_parts()), tagged(v.all_line_parts()))


@query(
    "transfer_summary",
    """select a.upload_id, count(*) as n_parts, count(l.size) as n_done, cast(coalesce(sum(l.size), 0) as bigint) as bytes_done,
         count(*) - count(l.size) as n_missing
       from all_line_parts a left join line_parts l using (upload_id, part_num) group by 1""",
)
def _(v: Views) -> DataFrame:
    return uploads.transfer_summary(v.all_line_parts(), v.line_parts())


@query(
    "retry_latest",
    """select upload_id, part_num, event_id, ok, md5, strftime(recorded_at, '%Y-%m-%d %H:%M:%S.%f') as recorded from (select *, row_number() over (
         partition by upload_id, part_num order by recorded_at desc, event_id desc) as rn from attempts where ok) where rn = 1""",
)
def _(v: Views) -> DataFrame:
    latest = uploads.retry_latest(v.attempts())
    return latest.withColumn("recorded", F.date_format("recorded_at", "yyyy-MM-dd HH:mm:ss.SSSSSS")).drop("recorded_at")


@query("select_cancellable", "select p.* from pending p semi join (select bucket, key from objects where object_id % 3 = 1) using (bucket, key)")
def _(v: Views) -> DataFrame:
    targets = v.manifest().filter("object_id % 3 = 1").select("bucket", "key")
    return uploads.select_cancellable(v.pending(), targets, allow_prefix=False)


_PREFIXES = """select distinct bucket, case cast(substr(bucket, 4) as integer) % 4 when 0 then '' when 1 then substr(key, 1, 3)
  when 2 then substr(key, 1, 4) else key end as key from objects where cast(substr(bucket, 4) as integer) % 5 <> 0"""


@query(
    "select_cancellable_prefix",
    f"select p.* from pending p where exists (select 1 from ({_PREFIXES}) t where t.bucket = p.bucket and starts_with(p.key, t.key))",
)
def _(v: Views) -> DataFrame:
    return uploads.select_cancellable(v.pending(), prefix_targets(v), allow_prefix=True)


def prefix_targets(v: Views) -> DataFrame:
    """Whole buckets, language folders, and single keys."""
    number = F.substring("bucket", 4, 9).cast("int")
    key = (
        F.when(number % 4 == 0, "").when(number % 4 == 1, F.substring("key", 1, 3)).when(number % 4 == 2, F.substring("key", 1, 4))
        .otherwise(F.col("key"))
    )
    return v.manifest().filter(number % 5 != 0).select("bucket", key.alias("key"))


@query(
    "reclaim_cancelled",
    """select c.upload_id, part_num, size, etag from completed c join pending p using (upload_id)
       where not exists (select 1 from objects o where o.object_id % 3 = 1 and o.bucket = p.bucket and o.key = p.key)""",
)
def _(v: Views) -> DataFrame:
    targets = v.manifest().filter("object_id % 3 = 1").select("bucket", "key")
    cancelled = uploads.select_cancellable(v.pending(), targets, allow_prefix=False)
    return uploads.reclaim_cancelled(v.completed().drop("object_id"), cancelled)


# --- policies ---------------------------------------------------------------------------------


@query("apply_exists_policy", f"select object_id, {decision()} from exists_decisions")
def _(v: Views) -> DataFrame:
    return policy.apply_exists_policy(v.requests(), v.dest_keys())


@query(
    "resolve_pending",
    f"select object_id, {decision()}, case when outcome = 'RESUME' then upload_id end as upload_id from pending_decisions",
)
def _(v: Views) -> DataFrame:
    return policy.resolve_pending(v.requests(), v.pending(), v.completed())


@query(
    "upload_decisions",
    f"select object_id, {decision()}, case when outcome = 'RESUME' then upload_id end as upload_id from upload_outcomes",
)
def _(v: Views) -> DataFrame:
    return policy.upload_decisions(v.requests(), v.dest_keys(), v.pending(), v.completed())


@query("apply_file_exists_policy", f"select object_id, {decision()} from download_outcomes")
def _(v: Views) -> DataFrame:
    return policy.apply_file_exists_policy(v.download_requests(), v.dest_before(), v.progress(), v.etags())


@query("check_progress_compat", f"select object_id, {decision()} from compat")
def _(v: Views) -> DataFrame:
    return policy.check_progress_compat(v.download_requests(), v.progress(), v.etags())


@query(
    "recheck_destination",
    f"""select object_id, file_exists, {decision()} from (select o.object_id, file_exists,
          case when outcome in ('NEW','LOAD','RESTART','DISCARD') and a.object_id is not null and b.object_id is null
            and file_exists is distinct from 'overwrite' then 'FileExists' else outcome end as outcome
          from download_outcomes o left join dest_after a using (object_id) left join dest_before b using (object_id))""",
)
def _(v: Views) -> DataFrame:
    requests = v.download_requests()
    decided = policy.apply_file_exists_policy(requests, v.dest_before(), v.progress(), v.etags())
    with_mode = decided.join(requests.select("object_id", "file_exists"), "object_id")
    return policy.recheck_destination(with_mode, v.dest_before(), v.dest_after())


@query(
    "reject_split",
    f"""select raw, bytes, error_class, {code('error_class')} as exit_code from (
        {_sizes_sql("bytes < 5242880 or bytes > 5368709120").replace("as reject_reason", "as error_class")})""",
)
def _(v: Views) -> DataFrame:
    good, bad = rejects.reject_split(sizes.normalise_sizes(v.size_texts(), "raw"), "reject_reason")
    return bad.unionByName(good, allowMissingColumns=True)


# --- keys -------------------------------------------------------------------------------------

_KEYS_SQL = """select object_id, key_id,
    case when octet_length(encode(key_text)) = 32 then case when is_master then sha256(encode(key_text || base || '/' || bucket || '/' || key))
      else lower(hex(encode(key_text))) end end as object_key
  from (select *, case when location = '' then 'https://s3.amazonaws.com' else 'https://s3-' || location || '.amazonaws.com' end as base
        from keyed_objects) left join key_table using (key_id)"""


@query(
    "derive_object_keys",
    f"""select object_id, key_id, object_key, base64(unhex(object_key)) as key_b64, base64(unhex(md5(unhex(object_key)))) as key_md5_b64,
          case when key_id is not null and object_key is null then 'InvalidEncryptionKey' end as reject_reason from ({_KEYS_SQL})""",
)
def _(v: Views) -> DataFrame:
    return object_keys(v)


def object_keys(v: Views) -> DataFrame:
    return crypto.derive_object_keys(v.keyed_objects().drop("content"), crypto.read_keys(v.key_table()))


def keyed_parts(v: Views) -> DataFrame:
    """Parts with the keys of their objects, or why they have none; joined before the content is cut."""
    keyed = v.objects().join(object_keys(v).select("object_id", "object_key", "reject_reason"), "object_id")
    return parts.split_parts(keyed.select("object_id", "object_key", "reject_reason", "content"), P)


@query(
    "encrypt_objects",
    """select object_id, part_num, case when object_id % 4 <> 2 then "end"-"start" + case when object_id % 4 = 3 then 0 else 28 end end as stored_size,
         case when object_id % 4 <> 2 then object_id % 4 <> 3 end as changed,
         case when object_id % 4 = 2 then 'InvalidEncryptionKey' end as reject_reason from parts""",
)
def _(v: Views) -> DataFrame:
    stored = crypto.encrypt_objects(keyed_parts(v).withColumn("plain", F.md5("bytes")))
    return stored.select(
        "object_id",
        "part_num",
        F.length("bytes").cast("bigint").alias("stored_size"),
        (F.md5("bytes") != F.col("plain")).alias("changed"),
        "reject_reason",
    )


@query(
    "decrypt_objects",
    """select object_id, part_num, wrong, case when not (wrong or bad) then md5(bytes) end as md5,
         case when wrong or bad then 'InvalidEncryptionKey' end as reject_reason
       from (select *, object_id % 4 in (0, 1) and part_num % 5 = 4 as wrong, object_id % 4 = 2 as bad from parts)""",
)
def _(v: Views) -> DataFrame:
    # Every fifth part of an encrypted object is read with a key that is not its own.
    wrong = F.col("object_key").isNotNull() & (F.col("part_num") % 5 == 4)
    stored = crypto.encrypt_objects(keyed_parts(v)).withColumn("wrong", wrong)
    asked = stored.withColumn("object_key", F.when(wrong, F.sha2(F.col("object_key").cast("binary"), 256)).otherwise(F.col("object_key")))
    opened = crypto.decrypt_objects(asked)
    return opened.select("object_id", "part_num", "wrong", F.md5("bytes").alias("md5"), "reject_reason")


@query("reencrypt_objects", """select object_id, part_num, case when object_id % 4 <> 2 then md5(bytes) end as md5,
  case when object_id % 4 = 2 then 'InvalidEncryptionKey' end as reject_reason from parts""")
def _(v: Views) -> DataFrame:
    stored = crypto.encrypt_objects(keyed_parts(v)).withColumn("new_key", F.sha2(F.col("object_id").cast("string").cast("binary"), 256))
    moved = crypto.reencrypt_objects(stored, "object_key", "new_key")
    opened = crypto.decrypt_objects(moved, "new_key")
    return opened.select("object_id", "part_num", F.md5("bytes").alias("md5"), "reject_reason")
