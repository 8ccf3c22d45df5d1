"""DuckDB SQL of the training-data queries that SQL can express."""

_WORDS = r"list_filter(string_split_regex({}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"

#: CRC-32 of a list of bytes in column expression ``{}`` (reflected polynomial EDB88320)
_CRC_TABLE = """crc as (select list(v order by i) as tab from (
    select i, list_reduce([i::ubigint] || [0::ubigint for x in range(8)],
        lambda c, z: if(c & 1 = 1, xor(c >> 1, 3988292384::ubigint), c >> 1)) as v from range(256) t(i)))"""
_CRC = """xor(list_reduce([4294967295::ubigint] || {}, lambda c, b: xor(c >> 8, tab[((xor(c, b) & 255) + 1)::bigint])), 4294967295::ubigint)"""
_BYTES = "list_transform(range(1, octet_length(encode({0})) + 1), lambda k: ('0x' || substr(hex(encode({0})), 2 * k - 1, 2))::ubigint)"

OP9 = r"""
with base as (select doc_id, coalesce(text, '') as t from documents),
words as (select doc_id, t, """ + _WORDS.format("t") + r""" as ws,
                 list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as ls from base),
wins as (select *, list_transform(range(1, greatest(len(ws) - 1, 1)), lambda k: ws[k] || ' ' || ws[k + 1] || ' ' || ws[k + 2]) as w3 from words),
pos as (select doc_id, unnest(w3) as w, unnest(range(1, len(w3) + 1)) as k, row_number() over () as r from wins where len(w3) > 0),
again as (select doc_id, k, count(*) over (partition by doc_id, w) as n from pos),
covered as (select doc_id, count(distinct j) as n from (select doc_id, unnest([k, k + 1, k + 2]) as j from again where n > 1) group by doc_id),
m as (select w.doc_id, len(ws)::bigint as n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::bigint as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
    (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines, coalesce(c.n, 0)::bigint as n_repeat_words, len(ls) as n_lines,
    len(list_filter(ws, lambda x: length(regexp_replace(x, '[^A-Z]', '', 'g')) > 1 and not regexp_matches(x, '[a-z]'))) as n_upper_words,
    length(regexp_replace(t, '[^!]', '', 'g')) as n_bangs
    from wins w left join covered c on c.doc_id = w.doc_id),
bits as (select *, (case when n_words < 50 then 1 else 0 end + case when 100 * n_repeat_words > 50 * n_words then 2 else 0 end
    + case when 10 * n_symbols > 3 * n_words then 4 else 0 end + case when 10 * n_upper_words > 4 * n_words then 8 else 0 end
    + case when 10 * n_dup_lines > 4 * n_lines then 16 else 0 end + case when 10 * n_bangs > 3 * n_words then 32 else 0 end
    + case when word_chars > 14 * n_words then 64 else 0 end + case when word_chars < 2 * n_words then 128 else 0 end)::bigint as failure_bits from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
    failure_bits = 0 as kept, failure_bits from bits
"""

OP2 = r"""
with recursive base as (select doc_id, """ + _WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')") + r""" as ws
    from documents),
sets as (select doc_id, case when len(ws) = 0 then [] when len(ws) < 4 then [array_to_string(ws, ' ')] else
    list_distinct(list_transform(range(1, len(ws) - 2), lambda k: ws[k] || ' ' || ws[k + 1] || ' ' || ws[k + 2] || ' ' || ws[k + 3])) end as s from base),
sized as materialized (select doc_id, len(s)::bigint as n, s from sets),
grams as materialized (select doc_id, n, hash(unnest(s)) as g from sized),
pairs as (select a.doc_id as a, b.doc_id as b, count(*) as both_, any_value(a.n) as na, any_value(b.n) as nb
    from grams a join grams b on a.g = b.g and a.doc_id < b.doc_id and 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n) group by 1, 2),
links as materialized (select a, b from pairs where 100 * both_ >= 85 * (na + nb - both_)),
edges as materialized (select a, b from links union all select b, a from links),
reach(x, y) as (select a, a from edges union select reach.x, edges.b from reach join edges on reach.y = edges.a)
select sized.doc_id, n as n_shingles, coalesce(least(sized.doc_id, min(y)), sized.doc_id) as component_id
from sized left join reach on reach.x = sized.doc_id group by sized.doc_id, n
"""

OP11 = r"""
with recursive base as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as t from documents),
measured as (select doc_id, part, t, """ + _WORDS.format("t") + r""" as ws, length(regexp_replace(t, '[^A-Z]', '', 'g')) as caps,
    min(doc_id) over (partition by t) as first_id from base),
failed as (select m.doc_id, part, (case when len(ws) < 50 then 'A' else '' end
    || case when 100 * len(list_distinct(ws)) < 65 * len(ws) then 'B' else '' end || case when 100 * caps > 5 * length(t) then 'C' else '' end
    || case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end || case when m.doc_id > first_id then 'E' else '' end) as f,
    coalesce(l.good, false) as good, coalesce(l.toxic, false) as toxic
    from measured m left join (select doc_id, bool_or(coalesce(quality = 1, false)) as good, bool_or(coalesce(toxic = 1, false)) as toxic
                               from labels group by doc_id) l on l.doc_id = m.doc_id),
sums as (select part, f, count(*) as n, count(*) filter (good) as n_good, count(*) filter (toxic) as n_toxic from failed group by all),
orders(o) as (select '' union all select o || c from orders, unnest(['A', 'B', 'C', 'D', 'E']) t(c) where not contains(o, c)),
steps as (select o as filter_order, k::int as step, substr(o, k, 1) as own, substr(o, 1, k - 1) as before
    from orders, unnest([1, 2, 3, 4, 5]) t(k) where length(o) = 5),
marked as (select sums.*, steps.*, contains(f, own) as fails, length(translate(f, before, '')) < length(f) as gone from sums, steps),
table_ as (select part, filter_order, step, any_value(own) as own, coalesce(sum(n) filter (not fails and not gone), 0)::bigint as kept,
    coalesce(sum(n) filter (fails and not gone), 0)::bigint as removed, coalesce(sum(n) filter (fails and gone), 0)::bigint as redundant,
    coalesce(sum(n) filter (f = own), 0)::bigint as unique_fails, coalesce(sum(n_good) filter (fails and not gone), 0)::bigint as good_lost,
    coalesce(sum(n_toxic) filter (fails and not gone), 0)::bigint as toxic_lost from marked group by 1, 2, 3)
select * exclude (own), sum(removed) over (partition by part, own)::bigint as shapley from table_
"""

_SHOWN = "coalesce({}::varchar, ' ')"
OP12 = r"""
with recursive """ + _CRC_TABLE + r""",
keyed as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as key from conversations),
hit as (select keyed.*, """ + _CRC.format(_BYTES.format("key")) + r""" % 20 as d from keyed, crc),
hurt as (select conv_id, turn, if(d = 4, 'user', role) as role,
    case d when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
    unnest(if(d = 3, [1, 2], [1])) as copy from hit where d <> 0),
rows_ as (select *, row_number() over w as k, first_value(copy) over same as c1, row_number() over same as nth,
    left(role, 1) as ini, lag(left(role, 1)) over w as prev from hurt
    window w as (partition by conv_id order by turn nulls first, role, md5(text), copy),
           same as (partition by conv_id, role, text order by turn nulls first, copy)),
faulty as materialized (select conv_id, k, role, text, ini, turn, prev, case when not regexp_matches(text, '[^\x20\x09-\x0D]') then 'blank'
    when nth > 1 then 'duplicate' when regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') then 'fine' else 'truncated' end as fault from rows_),
-- v: for each state of the pattern the least (cost, audit), as a cost of nine digits before the audit; '~' is none
ins as (select 1),
start_ as (select distinct conv_id from conversations),
parse(conv_id, k, v) as (
    select conv_id, 0::bigint, ['000000000', '~', '000000002I', '000000004II'] from start_
    union all
    select conv_id, k, [w[1], w[2], u2, least(w[4], if(u2 = '~', '~', lpad((left(u2, 9)::int + 2)::varchar, 9, '0') || substr(u2, 10) || 'I'))]
    from (
        select conv_id, k, w, least(w[3], if(p = '~', '~', lpad((left(p, 9)::int + 2)::varchar, 9, '0') || substr(p, 10) || 'I')) as u2
        from (select conv_id, k, w, least(w[1], w[2], w[4]) as p from (
            select p.conv_id, f.k, list_transform([1, 2, 3, 4], lambda q: list_aggregate(list_transform(
                list_filter([[q, 3, 68], 
                    if(f.fault in ('blank', 'duplicate') or q <> 2 or f.ini <> 's', null, [1, 0, 75]),
                    if(f.fault in ('blank', 'duplicate') or q <> 3 or f.ini <> 'u', null, [1, 0, 75]),
                    if(f.fault in ('blank', 'duplicate') or q <> 3 or f.ini <> 'u', null, [2, 0, 75]),
                    if(f.fault in ('blank', 'duplicate') or q <> 3 or f.ini <> 'u', null, [4, 0, 75]),
                    if(f.fault in ('blank', 'duplicate') or q <> 4 or f.ini <> 'a', null, [3, 0, 75]),
                    if(f.fault in ('blank', 'duplicate') or q <> 3, null, [1, 2, 82]),
                    if(f.fault in ('blank', 'duplicate') or q <> 3, null, [2, 2, 82]),
                    if(f.fault in ('blank', 'duplicate') or q <> 3, null, [4, 2, 82]),
                    if(f.fault in ('blank', 'duplicate') or q <> 4, null, [3, 2, 82])], lambda e: e is not null),
                lambda e: if(p.v[e[1]] = '~', '~', lpad((left(p.v[e[1]], 9)::int + e[2]
                    + if(f.fault = 'truncated' and e[3] <> 68, 1, 0))::varchar, 9, '0') || substr(p.v[e[1]], 10) || chr(e[3]::int))), 'min')) as w
            from parse p join faulty f on f.conv_id is not distinct from p.conv_id and f.k = p.k + 1)))),
solved as materialized (select conv_id, least(v[1], v[4]) as best from parse
    qualify row_number() over (partition by conv_id order by k desc) = 1),
audits as materialized (select conv_id, left(best, 9)::bigint as cost, substr(best, 10) as audit from solved),
edits as (select conv_id, audit, unnest(range(1, length(audit) + 1)) as i, unnest(string_split(audit, '')) as e from audits where audit <> ''),
placed as (select conv_id, audit, i, e, count(*) filter (e <> 'I') over w as k, count(*) filter (e <> 'D') over w as nth,
    (length(audit) - length(replace(audit, 'D', ''))) as gone from edits window w as (partition by conv_id order by i)),
turns as (select p.conv_id, p.i, case when e = 'K' then f.role when (nth + if((length(audit) - gone) % 2 = 1, 1, 0)) % 2 = 1 then 'user' else 'assistant' end
    || ':' || if(e = 'I', '', f.text) as line from placed p left join faulty f on f.conv_id is not distinct from p.conv_id and f.k = p.k where e <> 'D'),
texts as (select conv_id, string_agg(line, chr(10) order by i) as text from turns group by conv_id),
stats as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps, count(*) filter (fault = 'blank') as blank,
    count(*) filter (fault = 'duplicate') as duplicate, count(*) filter (fault = 'truncated') as truncated,
    count(*) filter (k > 1 and prev || ini not in ('su', 'ua', 'au')) as illegal from faulty group by conv_id)
select a.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
    coalesce(illegal, 0) as illegal, cost, audit, sha256(coalesce(t.text, '')) as repaired_sha256
from audits a left join stats s on s.conv_id is not distinct from a.conv_id left join texts t on t.conv_id is not distinct from a.conv_id
"""

OP13 = r"""
with """ + _CRC_TABLE + r""",
base as (select doc_id, coalesce(text, '') as t, octet_length(encode(coalesce(text, ''))) + 8 as size, md5(coalesce(text, '')) as h from documents),
texts as (select h, """ + _CRC.format(_BYTES.format("t")) + r""" as c from (select distinct h, t from base), crc),
placed as (select *, sum(size) over (order by h, doc_id nulls first rows unbounded preceding) - size as pos, sum(size) over () as total,
    sum(size) over (partition by h) as g_bytes, row_number() over (order by h, doc_id nulls first) as nth from base),
grouped as (select *, min(pos) over (partition by h) as g_at from placed),
dealt as (select *, ((if(g_bytes * 24 * 32 <= total, 2 * g_at + g_bytes, 2 * pos + size)::bigint * 24) // (2 * total)::bigint)::int as shard from grouped)
select doc_id, size::bigint as size, c::bigint as text_crc32, 'bytes' as law, shard, row_number() over (partition by shard order by nth) - 1 as slot,
    null::int as grown_shard from dealt join texts using (h)
"""

ORACLE = {"op9_quality_rules": OP9, "op2_ngram_jaccard_join": OP2, "op11_filter_audit": OP11, "op12_conversation_repair": OP12,
          "op13_sharding": OP13}
