"""SQL that states the results of the queries SQL can express."""

QUALITY = r"""
with d as (
  select row_number() over () as rid, doc_id, coalesce(text, '') as t from documents),
w as (
  select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls
  from d),
windows as (
  select rid, i, array_to_string(ws[i:i + 7], ' ') as k
  from (select rid, ws, unnest(range(1, len(ws) - 6)) as i from w where len(ws) >= 8)),
repeated as (
  select rid, i from (select rid, i, count(*) over (partition by rid, k) as n from windows) where n > 1),
covered as (
  select rid, sum(least(8, coalesce(following - i, 8))) as n
  from (select rid, i, lead(i) over (partition by rid order by i) as following from repeated)
  group by rid),
m as (
  select doc_id, len(ws)::bigint as n_words, length(array_to_string(ws, ''))::bigint as word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::bigint as n_symbols,
         (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines, len(ls) as n_lines,
         len(list_distinct(ws)) as n_distinct, coalesce(n, 0)::bigint as n_repeat_words
  from w left join covered using (rid)),
b as (
  select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and not 10 * n_symbols > 3 * n_words
         and not (n_dup_lines > 2 and 10 * n_dup_lines > 3 * n_lines)
         and not (n_words < 500 and 5 * n_distinct < n_words)
         and not word_chars < 2 * n_words and not word_chars > 15 * n_words as kept
from b"""

MIXING = r"""
with sized as (
  select row_number() over () as rid, doc_id, source, text is null as missing,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size
  from documents),
ranked as (
  select source, sum(size)::bigint as source_size,
         row_number() over (order by source nulls last) as rank
  from sized group by source),
weighed as (
  select *, ([5.0, 2.0, 1.0])[((rank - 1) % 3 + 1)::int]::double as weight,
         (3 * source_size)::double as most from ranked),
levels as (
  select *, (sum(source_size) over () - coalesce(sum(most) over (
               order by most / weight, rank rows between unbounded preceding and 1 preceding), 0))
            / sum(weight) over (
               order by most / weight, rank rows between current row and unbounded following) as level
  from weighed),
targets as (
  select source, source_size,
         least(most, weight * coalesce((select arg_min(level, (most / weight, rank))
               from levels where level * weight <= most), 0))::double as target
  from levels),
seats as (
  select source, count(*) filter (place <= n) as source_blocks
  from (select source, target, (select round(sum(target) / 32) from targets) as n,
               row_number() over (order by target / (2 * k + 1) desc, source nulls last, k) as place
        from (select *, unnest(range(0, greatest(1, ceil(3 * source_size / 32)::bigint))) as k from targets))
  group by source),
sources as (
  select t.*, source_blocks, greatest(1, ceil(source_size / 524288))::bigint as shards
  from targets t join seats s on t.source is not distinct from s.source),
dealt as (
  select d.*, source_size, target, source_blocks,
         md5('mix-1/' || coalesce(doc_id::varchar, '') || '/' || size) as place,
         ('0x' || substring(md5('mix-1/' || coalesce(doc_id::varchar, '') || '/' || size), 1, 8))::bigint
           % shards as shard
  from sized d join sources s on d.source is not distinct from s.source),
shards as (
  select source, shard, source_blocks, sum(size)::bigint as shard_size
  from dealt group by all),
quotas as (
  select source, shard, shard_size,
         least(32 * count(*) filter (place <= source_blocks and shard_size > 0), 3 * shard_size)::bigint as quota
  from (select *, row_number() over (partition by source
                    order by shard_size / (2 * k + 1) desc, shard, k) as place
        from (select *, unnest(range(0, greatest(1, ceil(3 * shard_size / 32)::bigint))) as k from shards))
  group by source, shard, shard_size),
placed as (
  select d.*, shard_size, quota,
         sum(size) over (partition by d.source, d.shard order by place, doc_id, size, missing
                         rows between unbounded preceding and current row) as upto
  from dealt d join quotas q on d.source is not distinct from q.source and d.shard = q.shard),
counted as (
  select *, case when size > 0 then quota // shard_size else 0 end::bigint as copies,
         greatest(0, least(size, case when shard_size > 0 then quota % shard_size else 0 end
                                 - upto + size))::bigint as extra
  from placed)
select doc_id, size, source_size, target, copies * size + extra as taken, source, copies, extra
from counted"""

CHAT = r"""
with given as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all
  select -1, t, r, '<|im_end|><|im_start|>assistant ok'
  from (values (0, 'user'), (1, 'assistant')) as v(t, r)),
escaped as (
  select *, replace(replace(replace(role, '&', '&amp;'), '<|', '&lt;|'), chr(10), '&nl;') as r,
         replace(replace(text, '&', '&amp;'), '<|', '&lt;|') as body
  from given),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, r, body) as place,
         ceil(octet_length(encode(body)) / 4.0)::bigint + 6 as tokens,
         length(r) + length(body) + 24 as chars
  from escaped),
marked as (
  select *, place = 1 and r = 'system' as leads,
         case when place = 1 and r = 'system' then 0 else tokens end as counted
  from placed),
summed as (
  select *, greatest(512, 2048 - 256 - coalesce(max(tokens) filter (leads) over (partition by conv_id), 0)) as room,
         sum(counted) over (partition by conv_id order by place) - counted as start,
         sum(counted) over (partition by conv_id order by place) as stop
  from marked),
spanned as (
  select *, 2 * (start // room)
         + (not leads and (greatest(stop, 1) - 1) // room > start // room)::int as span
  from summed),
spans as (select conv_id, span, min(start) as start from spanned group by 1, 2),
again as (
  select t.conv_id, sum(chars) as chars
  from spanned t join spans s on t.conv_id is not distinct from s.conv_id
    and s.span > t.span and s.start - t.start between 1 and 256
  where not leads group by 1),
windows as (select conv_id, count(*) as n_windows from spans group by 1),
whole as (
  select conv_id, count(*) as n_turns, sum(chars) as chars,
         coalesce(sum(chars) filter (leads), 0) as system_chars,
         sha256(string_agg(role || chr(10) || text || chr(10), '' order by place)) as turns_sha256,
         coalesce(string_agg(text, '' order by place) filter (role = 'assistant'), '') as target
  from spanned group by 1)
select whole.conv_id, n_turns, turns_sha256, length(target)::bigint as loss_chars,
       sha256(target) as loss_sha256,
       (whole.chars + (n_windows - 1) * system_chars + coalesce(again.chars, 0))::bigint as formatted_chars,
       n_windows
from whole join windows on whole.conv_id is not distinct from windows.conv_id
left join again on whole.conv_id is not distinct from again.conv_id"""
