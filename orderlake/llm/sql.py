"""SQL of equal meaning for the queries that it can express, for an independent engine."""

PREFERENCE_PAIRS = """
with answers as (
  select conv_id pair_id, max(turn) last_turn, max_by(coalesce(text, ''), turn) answer
  from conversations where role = 'assistant' and conv_id is not null and turn is not null group by conv_id
), donors as (
  select a.pair_id, a.last_turn,
    case when f.pair_id is null then (select arg_min(answer, pair_id) from answers) else f.answer end other
  from answers a left join answers f on f.pair_id = a.pair_id + 1
), turns as (
  select 'c' side, conv_id pair_id, turn, role, text from conversations join answers on conv_id = pair_id
  union all
  select 'r', conv_id, turn, role, text from conversations join donors on conv_id = pair_id where turn < last_turn
  union all
  select 'r', pair_id, last_turn, 'assistant', other from donors
), ranked as (
  select *, row_number() over (partition by side, pair_id order by turn, role, text) k,
    '<|im_start|>' || coalesce(role, '') || chr(10) head,
    replace(coalesce(text, ''), '<|im_', '< |im_') || '<|im_end|>' body
  from turns
), c as (select * from ranked where side = 'c'), r as (select * from ranked where side = 'r'),
prefix as (
  select coalesce(c.pair_id, r.pair_id) pair_id,
    coalesce(min(case when c.k is null or r.k is null or c.role is distinct from r.role
      or c.text is distinct from r.text then coalesce(c.k, r.k) end) - 1, count(*)) n
  from c full join r on c.pair_id = r.pair_id and c.k = r.k group by 1
), laid as (
  select x.*, n, x.k > n rest,
    sum(case when x.k > n then length(head) + length(body) + 1 else 0 end)
      over (partition by side, x.pair_id order by x.k) - length(body) - 1 first
  from ranked x join prefix using (pair_id)
)
select pair_id,
  coalesce(string_agg(head || body || chr(10), '' order by k) filter (where side = 'c' and not rest), '') prompt,
  max(n)::bigint prompt_turns,
  coalesce(string_agg(head || body || chr(10), '' order by k) filter (where side = 'c' and rest), '') chosen,
  coalesce(string_agg(head || body || chr(10), '' order by k) filter (where side = 'r' and rest), '') rejected,
  coalesce(string_agg(first::bigint || '-' || (first + length(body))::bigint, ',' order by k)
    filter (where side = 'c' and rest and role = 'assistant'), '') chosen_mask,
  coalesce(string_agg(first::bigint || '-' || (first + length(body))::bigint, ',' order by k)
    filter (where side = 'r' and rest and role = 'assistant'), '') rejected_mask,
  bool_or(rest) differ
from laid group by pair_id
"""

LINE_DEDUP = r"""
with shown as (
  select page_id, nullif(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1)), '') host,
    regexp_replace(regexp_replace(regexp_replace(html,
      '(?is)<script\b[^>]*>.*?</script>|<style\b[^>]*>.*?</style>|<!--.*?-->', ' ', 'g'),
      '(?i)</?(?:p|div|br|hr|li|ul|ol|nav|h[1-6]|table|tr|td|th|article|section|header|footer|title|body|head|html)\b[^>]*>',
      chr(10), 'g'), '<[^>]*>', '', 'g') text
  from pages
), lines as (
  select page_id, coalesce(host, '') host, unnest(string_split(text, chr(10))) line,
    unnest(range(len(string_split(text, chr(10))))) k
  from shown
), totals as (select coalesce(host, '') host, count(*) pages from shown group by 1
), boilerplate as (
  select host, line from (select distinct page_id, host, trim(line, ' ') line from lines where trim(line, ' ') <> '')
  join totals using (host) group by host, line, pages having count(*) >= 3 and count(*) > 0.1 * pages
), judged as (
  select l.*, b.line is not null dropped
  from lines l left join boilerplate b on l.host = b.host and trim(l.line, ' ') = b.line
)
select s.page_id, s.host,
  case when s.text is not null then coalesce(string_agg(line, chr(10) order by k) filter (where not dropped), '') end text,
  count(*) filter (where trim(line, ' ') <> '') n_lines, count(*) filter (where dropped) n_dropped
from shown s left join judged j using (page_id) group by s.page_id, s.host, s.text
"""

CONVERSATION_TRIE = """
with bytes as (
  select distinct conv_id, conv_id - conv_id % 100 base,
    flatten(list_transform(string_split(conv_id::varchar, ''), lambda d: [ascii(d)::bigint, -1, -1, -1, -1, -1, -1, -1, -1])) steps
  from conversations where conv_id is not null
), convs as (
  select conv_id, base, xor(list_reduce(steps, lambda a, x:
    case when x >= 0 then xor(a, x) when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end, 4294967295), 4294967295) % 6 head
  from bytes
), turns as (
  select conv_id, coalesce(role, '') role, coalesce(text, '') text,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) place
  from conversations where conv_id is not null
), shared as (
  select c.conv_id, count(t.place) n from convs c left join turns t on t.conv_id = c.base and t.place <= c.head group by 1
), rebuilt as (
  select c.conv_id, t.place d, role, text from convs c join turns t on t.conv_id = c.base and t.place <= c.head
  union all
  select c.conv_id, t.place - c.head + s.n, role, text
  from convs c join shared s using (conv_id) join turns t on t.conv_id = c.conv_id and t.place > c.head
), ways as materialized (
  select conv_id, 0 d, [] path, 0 n_chars from convs
  union all
  select conv_id, d, list([role, text]) over (partition by conv_id order by d), length(text) from rebuilt
), nodes as materialized (
  select d, path, min(conv_id) conv_id, count(*) n_convs, any_value(n_chars) n_chars from ways group by d, path
), along as materialized (
  select w.conv_id, w.d, n.conv_id node from ways w join nodes n using (d, path)
), linked as materialized (
  select n.*, a.node parent, (select count(*) from nodes m join along b on b.conv_id = m.conv_id and b.d = m.d - 1
    where m.d = n.d + 1 and b.node = n.conv_id) n_children
  from nodes n left join along a on a.conv_id = n.conv_id and a.d = n.d - 1
), totals as (
  select a.node, a.d, count(*) filter (where n_children = 0) n_leaves, sum((n_convs - 1) * n_chars) saved
  from linked l join along a on a.conv_id = l.conv_id and a.d <= l.d group by 1, 2
), last as (
  select conv_id, max(d) d from ways group by 1
), ends as (
  select node, d, string_agg(conv_id::varchar, ',' order by conv_id) ids from last join along using (conv_id, d) group by 1, 2
)
select l.conv_id, l.d::bigint depth, l.parent parent_conv_id, l.n_convs, l.n_children, t.n_leaves,
  t.saved::bigint saved_tokens, sha256(coalesce(e.ids, '')) ends_sha256
from linked l join totals t on t.node = l.conv_id and t.d = l.d left join ends e on e.node = l.conv_id and e.d = l.d
"""

EXACT_TOP_K = """
with v as materialized (
  select vec_id, row_number() over () row, list_transform(embedding, lambda x: floor(256 * x::double)) parts from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.row, q.vec_id query_id, c.vec_id, list_inner_product(q.parts, c.parts)::bigint score
  from v q join v c on q.row <> c.row where q.vec_id % 50 = 0
), ranked as (
  select *, row_number() over (partition by row order by score desc, vec_id nulls last) rank from scored
)
select query_id, rank::integer rank, vec_id, score from ranked where rank <= 5
"""

_ROUND = """, dealt_{k} as materialized (
  select row, part, arg_min(entry, (list_inner_product(cut, cut) - 2 * list_inner_product(cut, centre)
    + list_inner_product(centre, centre)) * 256 + entry) entry
  from parts join book_{k} using (part) group by row, part
), means_{k} as (
  select part, entry, list(mean order by place) centre from (
    select part, entry, place, floor(sum(cut[place]) / count(*)) mean
    from dealt_{k} join parts using (row, part), range(1, len(cut) + 1) p(place) group by part, entry, place)
  group by part, entry
), book_{next} as materialized (
  select part, entry, coalesce(m.centre, b.centre) centre from book_{k} b left join means_{k} m using (part, entry)
)"""

VECTOR_CODES = (
    """
with v as materialized (
  select vec_id, label, row_number() over (order by vec_id nulls last) row,
    list_transform(embedding, lambda x: floor(1024 * x::double)) whole from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), parts as materialized (
  select row, part, list_slice(whole, part * len(whole) // 4 + 1, (part + 1) * len(whole) // 4) cut from v, range(4) p(part)
), book_0 as materialized (
  select part, row - 1 entry, cut centre from parts where row <= 256
)"""
    + "".join(_ROUND.format(k=k, next=k + 1) for k in range(4))
    + """, last as (
  select row, part, min((list_inner_product(cut, cut) - 2 * list_inner_product(cut, centre)
    + list_inner_product(centre, centre)) * 256 + entry)::bigint nearest
  from parts join book_4 using (part) group by row, part
), coded as (
  select row, string_agg(printf('%02x', nearest % 256), '' order by part) code, sum(nearest // 256)::bigint error
  from last group by row
)
select vec_id, code, error, sum(error) over (partition by label)::bigint label_error,
  (select sha256(string_agg(array_to_string(list_transform(centre, lambda x: x::bigint::varchar), ','), ',' order by part, entry))
   from book_4) codebooks_sha256
from coded join v using (row)
"""
)
