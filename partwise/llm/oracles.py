"""SQL of queries whose levels or steps are written out."""

from __future__ import annotations


def crc32(text: str) -> str:
    """The unsigned CRC-32 of a text of ASCII characters, bit by bit."""
    return f"""xor(4294967295, list_reduce(
        list_prepend(4294967295::bigint, list_transform(string_split({text}, ''), lambda c: ascii(c)::bigint)),
        lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0]::bigint[],
            lambda x, step: xor(x >> 1, case when x & 1 = 1 then 3988292384 else 0 end))))"""


def merkle(fanout: int = 16, depth: int = 7, group_depth: int = 4) -> str:
    """Trees of at most fanout ** depth leaves for each source, and fanout ** group_depth sources."""

    def framed(value: str) -> str:
        return f"coalesce(strlen(({value})::varchar) || ':' || ({value})::varchar, '-')"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    claimed = f"case when {crc32('doc_id::varchar')} % 5 = 0 then {lower} else text end"
    head = " || ".join(framed(c) for c in ("doc_id", "source", "lang", "n_chars"))
    steps = [f"""
        leaves as (
            select doc_id, coalesce('=' || source, '') as grp, sha256({head} || {framed('text')}) as leaf,
                sha256({head} || {framed(claimed)}) as claimed
            from documents
        ), u0 as (
            select *, row_number() over (partition by grp order by doc_id nulls first, leaf) - 1 as r, leaf as node, '' as proof, claimed as fold,
                count(*) over (partition by grp) as n
            from leaves
        )"""]

    def level(i: int, prefix: str, keys: str, group: str) -> str:
        here, there = f"{prefix}{i}", f"{prefix}{i + 1}"
        return f"""
        {here}n as (select distinct {group}, r, node from {here} where n > 1),
        {here}p as (
            select {group}, r // {fanout} as p, sha256(string_agg(node, '' order by r)) as digest,
                list(node order by r) as run
            from {here}n group by all
        ), {there} as (
            select {keys}, case when n > 1 then r // {fanout} else r end as r, coalesce(digest, node) as node,
                case when n > 1 then proof || array_to_string(run[:r % {fanout}], '') || array_to_string(run[r % {fanout} + 2:], '') else proof end as proof,
                case when n > 1 then sha256(array_to_string(run[:r % {fanout}], '') || fold || array_to_string(run[r % {fanout} + 2:], '')) else fold end as fold,
                (n + {fanout} - 1) // {fanout} as n
            from {here} left join {here}p on {here}.{group} = {here}p.{group} and r // {fanout} = p and n > 1
        )"""

    steps += [level(i, "u", "doc_id, u%d.grp, leaf" % i, "grp") for i in range(depth)]
    steps.append(f"""
        named as (select grp, node as subroot, row_number() over (order by grp) - 1 as r, count(*) over () as n from (select distinct grp, node from u{depth})),
        v0 as (
            select doc_id, leaf, subroot, 'all' as one, named.r as r, subroot as node, proof, fold, named.n as n
            from u{depth} join named using (grp)
        )""")
    steps += [level(i, "v", "doc_id, leaf, subroot, v%d.one" % i, "one") for i in range(group_depth)]
    return "with " + ",".join(steps) + f"""
        select doc_id, leaf, subroot, node as root, sha256(proof) as proof_sha256, fold as folded_root, fold = node as verified
        from v{group_depth}"""


def conversations() -> str:
    """Least cheapest edits by a forward step for each row, over states '', s, u and a; lines begin with a newline."""
    key = "coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')"
    white = r"\x20\x09-\x0D"
    return rf"""
        with recursive how as materialized (
            select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, {crc32(key)} % 20 as h
            from conversations
        ), damaged as (
            select conv_id, turn, case when h = 4 then 'user' else role end as role,
                case when h = 1 then '' when h = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
                unnest(range(case when h = 3 then 2 else 1 end)) as copy
            from how where h <> 0
        ), judged as materialized (
            select conv_id, turn, role, text, left(role, 1) as initial,
                row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as i,
                lag(left(role, 1)) over (partition by conv_id order by turn nulls first, role, text, copy) as earlier,
                case when not regexp_matches(text, '[^{white}]') then 'blank'
                    when row_number() over (partition by conv_id, role, text order by turn nulls first, copy) > 1 then 'duplicate'
                    when not regexp_matches(text, '[.!?][{white}]*$') then 'truncated' else '' end as fault
            from damaged
        ), edits(q, kind, initial, q2, cost, line) as (
            values ('', 'D', null, '', 4, null), ('s', 'D', null, 's', 4, null), ('u', 'D', null, 'u', 4, null), ('a', 'D', null, 'a', 4, null),
                ('', 'K', 's', 's', 0, null), ('', 'K', 'u', 'u', 0, null), ('s', 'K', 'u', 'u', 0, null), ('a', 'K', 'u', 'u', 0, null),
                ('u', 'K', 'a', 'a', 0, null), ('', 'R', null, 'u', 3, 'user'), ('s', 'R', null, 'u', 3, 'user'),
                ('a', 'R', null, 'u', 3, 'user'), ('u', 'R', null, 'a', 3, 'assistant')
        ), inserts(q, q2, cost, audit, lines) as (
            values ('', '', 0, '', ''), ('s', 's', 0, '', ''), ('u', 'u', 0, '', ''), ('a', 'a', 0, '', ''),
                ('', 'u', 3, 'I', chr(10) || 'user:'), ('s', 'u', 3, 'I', chr(10) || 'user:'), ('a', 'u', 3, 'I', chr(10) || 'user:'),
                ('u', 'a', 3, 'I', chr(10) || 'assistant:'), ('', 'a', 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
                ('s', 'a', 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')
        ), best as (
            select conv_id, 0::bigint as i, q2 as q, struct_pack(cost := cost::bigint, audit := audit, lines := lines) as b
            from (select distinct conv_id from judged), inserts where q = ''
            union all
            select best.conv_id, best.i + 1, n.q2, min(struct_pack(
                cost := (b.cost + e.cost + case when e.kind <> 'D' and fault = 'truncated' then 3 else 0 end + n.cost)::bigint,
                audit := b.audit || e.kind || n.audit,
                lines := b.lines || case when e.kind = 'D' then '' else chr(10) || coalesce(e.line, j.role) || ':' || j.text end || n.lines))
            from best join judged j on j.conv_id is not distinct from best.conv_id and j.i = best.i + 1
                join edits e on e.q = best.q and (e.kind = 'D' or j.fault not in ('blank', 'duplicate'))
                    and (e.kind <> 'K' or e.initial = j.initial)
                join inserts n on n.q = e.q2
            group by best.conv_id, best.i + 1, n.q2
        ), counted as (
            select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps,
                count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
                count(*) filter (fault = 'truncated') as truncated,
                count(*) filter (i > 1 and earlier || initial not in ('su', 'ua', 'au')) as illegal, max(i) as last
            from judged group by conv_id
        ), ended as (
            select best.conv_id, min(b) as b from best join counted c on c.conv_id is not distinct from best.conv_id and i = last
            where q in ('', 'a') group by best.conv_id
        )
        select o.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
            coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(b.cost, 0) as cost,
            coalesce(b.audit, '') as audit, sha256(coalesce(b.lines[2:], '')) as repaired_sha256
        from (select distinct conv_id from conversations) o
            left join counted c on c.conv_id is not distinct from o.conv_id
            left join ended d on d.conv_id is not distinct from o.conv_id"""
