"""DuckDB side of the scenarios: a query is put together with the views it names."""

from __future__ import annotations

import re

from fixtures.views import KEYS, LINE_P, LOCATIONS, N_SLOTS, P, SIZE_TEXTS, SIZE_UNITS
from partwise.functions.sizes import unit_factors


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


VIEWS = {
    "objects": """
        select doc_id as object_id, source as bucket,
          case doc_id % 3 when 0 then '' when 1 then 'us-west-1' else 'eu-west-1' end as location,
          lang || '/' || doc_id || '.txt' as key, encode(text) as content,
          cast(octet_length(encode(text)) as bigint) as size from documents""",
    "parts": f"""
        select object_id, part_num, part_num*{P} as "start", least(part_num*{P}+{P}, size) as "end",
          unhex(substr(hex(content), part_num*{2 * P}+1, {2 * P})) as bytes
        from (select *, unnest(range(greatest(1, cast(ceil(size/{P}.0) as bigint)))) as part_num from objects)""",
    "part_digests": """select object_id, part_num, "end"-"start" as size, md5(bytes) as md5 from parts""",
    "etags": """
        select object_id, md5(unhex(string_agg(md5,'' order by part_num))) || '-' || count(*) as etag,
          cast(sum(size) as bigint) as size from part_digests group by 1""",
    "dest": """
        select object_id, case when object_id % 8 = 0 then md5('stale') || '-1' else etag end as etag, size,
          case when object_id % 12 = 0 then 'kA' end as key_id from etags where object_id % 4 = 0
        union all select object_id + 1000000, etag, size, null from etags where object_id % 50 = 0""",
    "pending": """
        select object_id || '-' || k as upload_id, object_id, bucket, key from objects, (values (0),(1)) v(k)
        where k < case object_id % 5 when 1 then 1 when 2 then 1 when 3 then 2 else 0 end""",
    "completed": """
        select object_id || '-0' as upload_id, object_id, part_num,
          case when object_id % 20 = 11 and part_num > 0 then 100 + part_num else size end as size, md5 as etag
        from part_digests
        where object_id % 5 in (1,2) and object_id % 10 <> 6 and (part_num*3+object_id) % 4 <> 0""",
    "requests": """
        select object_id, bucket, key, case object_id % 3 when 1 then 'overwrite' when 2 then 'skip' end as "exists",
          case when object_id % 7 in (3,4,6) then 'resume' when object_id % 7 = 5 then 'force' end as resume_mode,
          cast(case when object_id % 11 = 0 then 2048 else 1024 end as bigint) as part_size,
          case when object_id % 24 = 0 then 'kA' end as key_id from objects""",
    "progress": """
        select d.object_id, cast(case when d.object_id % 13 = 0 then 2048 else 1024 end as bigint) as part_size,
          case when d.object_id % 10 = 4 then 'stale-etag' else e.etag end as etag, part_num,
          case when (d.object_id+part_num) % 9 = 0 then repeat('0',32)
               when (d.object_id+part_num) % 7 = 0 then md5('corrupt') else md5 end as md5
        from part_digests d join etags e using (object_id)
        where d.object_id % 2 = 0 and (d.object_id+part_num) % 3 <> 0""",
    "download_requests": f"""
        select object_id, case object_id % 3 when 1 then 'overwrite' when 2 then 'skip' end as file_exists,
          case when object_id % 7 in (2,3,4) then 'resume' when object_id % 7 in (5,6) then 'discard' end as download_exists,
          cast({P} as bigint) as part_size from objects""",
    "dest_before": "select object_id from objects where object_id % 5 = 0",
    "dest_after": "select object_id from objects where object_id % 5 = 0 or object_id % 17 = 0",
    "locations": f"""
        select page_id as id, url as raw from pages
        union all select object_id, 's3://' || bucket || '/' || key from objects
        union all select * from (values {", ".join(f"({i}, {text(u)})" for i, u in LOCATIONS)}) v(id,raw)""",
    "size_texts": f"""
        select l_partkey || '.' || l_linenumber || [{", ".join(map(text, SIZE_UNITS))}][l_suppkey % {len(SIZE_UNITS)} + 1] as raw
        from lineitem
        union all select * from (values {", ".join(f"({text(t)})" for t in SIZE_TEXTS)}) v(raw)""",
    "attempts": f"""
        select user_id as upload_id, event_id % {N_SLOTS} as part_num, ts as recorded_at, event_id,
          event_type <> 'error' as ok, md5(props) as md5 from events""",
    "all_line_parts": f"""
        select l_orderkey as upload_id, cast(row_number() over (partition by l_orderkey
          order by l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity)-1 as bigint) as part_num,
          cast(least(l_quantity, {LINE_P}) as bigint) as size from lineitem""",
    "line_parts": "select * from all_line_parts where not (upload_id % 5 = 0 and part_num = 1)",
    "turn_parts": """
        select conv_id as object_id, turn as part_num, encode(text) as bytes from conversations""",
    "key_table": f"""
        select * from (values {", ".join(f"({text(k)}, {text(t)}, {str(m).lower()})" for k, t, m in KEYS)}) v(key_id,key_text,is_master)""",
    "keyed_objects": """
        select *, case object_id % 4 when 0 then 'kA' when 1 then 'kB' when 2 then 'kBad' end as key_id from objects""",
    "hist": "select upload_id, size, count(*) as num_parts from line_parts group by 1, 2",
    "completed_hist": "select upload_id, size, count(*) as num_parts from completed group by 1, 2",
    "guessed": """
        select upload_id, max(size) as part_size,
          count(*) > 2 or (count(*) = 2 and arg_min(num_parts, size) <> 1) as ambiguous
        from completed_hist group by 1""",
    "exists_decisions": """
        select r.object_id,
          case when d.object_id is null then 'CONTINUE'
               when d.key_id is distinct from r.key_id then 'InvalidEncryptionKey'
               when r."exists" = 'overwrite' then 'CONTINUE' when r."exists" = 'skip' then 'SKIP'
               else 'ObjectExists' end as outcome
        from requests r left join dest d using (object_id)""",
    "pending_state": """
        select bucket, key, count(*) as n, min(upload_id) as upload_id, min(part_size) as guessed_size,
          bool_or(ambiguous) as ambiguous
        from pending left join guessed using (upload_id) group by 1, 2""",
    "pending_decisions": """
        select r.object_id, p.upload_id,
          case when p.n is null then 'NEW' when resume_mode = 'force' then 'CANCEL_AND_NEW'
               when p.n > 1 then 'MultipleUploadsExist' when resume_mode is null then 'UploadExists'
               when p.ambiguous then 'AmbiguousPartSize'
               when p.guessed_size <> r.part_size then 'IncompatiblePartSize' else 'RESUME' end as outcome
        from requests r left join pending_state p using (bucket, key)""",
    "upload_outcomes": """
        select e.object_id, case when e.outcome = 'CONTINUE' then p.outcome else e.outcome end as outcome, p.upload_id
        from exists_decisions e join pending_decisions p using (object_id)""",
    "headers": """
        select object_id, max(part_size) as recorded_size, max(etag) as recorded_etag from progress group by 1""",
    "compat": """
        select r.object_id, case when h.recorded_size <> r.part_size then 'IncompatiblePartSize'
          when h.recorded_etag = e.etag then 'LOAD' else 'RESTART' end as outcome
        from download_requests r join headers h using (object_id) left join etags e using (object_id)""",
    "download_outcomes": """
        select r.object_id, r.file_exists,
          case when d.object_id is not null and file_exists is null then 'FileExists'
               when d.object_id is not null and file_exists = 'skip' then 'SKIP'
               when h.object_id is null then 'NEW' when download_exists is null then 'DownloadExists'
               when download_exists = 'discard' then 'DISCARD' else c.outcome end as outcome
        from download_requests r left join dest_before d using (object_id)
          left join headers h using (object_id) left join compat c using (object_id)""",
}

_CODES = """case {0} when 'UserError' then 2 when 'ObjectExists' then 3 when 'UploadExists' then 4
  when 'InvalidSourceURL' then 5 when 'InvalidDestinationURL' then 6 when 'InvalidS3URL' then 7
  when 'IncompatiblePartSize' then 8 when 'InvalidChecksumAlgorithm' then 9 when 'InvalidEncryptionKey' then 10
  when 'FileExists' then 11 when 'DownloadExists' then 12 when 'MultipleUploadsExist' then 13
  when 'PermissionDenied' then 14 when 'AmbiguousPartSize' then 1 end"""


def code(column: str) -> str:
    return f"cast({_CODES.format(column)} as integer)"


_ACTIONS = "('CONTINUE','SKIP','NEW','RESUME','CANCEL_AND_NEW','LOAD','RESTART','DISCARD')"


def decision(column: str = "outcome") -> str:
    """action, error_class and exit_code of an outcome."""
    error = f"case when {column} not in {_ACTIONS} then {column} end"
    return (
        f"case when {column} in {_ACTIONS} then {column} else 'FAIL' end as action, "
        f"{error} as error_class, {code(error)} as exit_code"
    )


def _needed(sql: str, found: dict[str, None]) -> None:
    for name in VIEWS:
        if name not in found and re.search(rf"\b(?:from|join)\s+{name}\b", sql):
            _needed(VIEWS[name], found)
            found[name] = None


def with_views(sql: str) -> str:
    found: dict[str, None] = {}
    _needed(sql, found)
    ctes = ",\n".join(f"{name} as ({VIEWS[name].strip()})" for name in found)
    sql = sql.strip()
    if not ctes:
        return sql
    if sql.startswith("with "):
        return f"with {ctes},\n{sql.removeprefix('with ')}"
    return f"with {ctes}\n{sql}"

SYMBOL_SQL = "select distinct * from (values " + ", ".join(
    f"({text(unit)}, {factor!r}::double)" for unit, factor in unit_factors().items()
) + ") v(unit, factor)"
