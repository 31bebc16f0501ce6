"""SQL of other engines for the numbered queries that SQL can express."""

from __future__ import annotations

from . import chat, decontam, linededup, ranked, trie, warc

_WORD = "[^\\x20\\x09-\\x0D]+"
_ESC = "replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"

# Every window of words whose like stands earlier goes, but for what it shares with its first place in the same document.
OP3 = f"""with d as (select doc_id, text, regexp_extract_all(coalesce(text, ''), '{_WORD}[\\x20\\x09-\\x0D]*') as t from documents),
 w as (select doc_id, unnest(t) as tok, generate_subscripts(t, 1) - 1 as i from d),
 win as (select doc_id, i, string_agg(regexp_extract(tok, '{_WORD}'), ' ') over f as body, count(*) over f as k from w window f as (partition by doc_id order by i rows between current row and {linededup.MIN_WORDS - 1} following)),
 r as (select doc_id, i, row_number() over o as k, first_value(doc_id) over o as fd, first_value(i) over o as fi from win where k = {linededup.MIN_WORDS} window o as (partition by body order by doc_id, i)),
 gone as (select distinct doc_id, unnest(range(case when fd = doc_id then greatest(i, fi + {linededup.MIN_WORDS}) else i end, i + {linededup.MIN_WORDS})) as i from r where k > 1),
 kept as (select w.doc_id, w.tok, w.i, g.i is not null as gone from w left join gone g on w.doc_id = g.doc_id and w.i = g.i),
 spans as (select doc_id, i, gone, i - row_number() over (partition by doc_id, gone order by i) as grp from kept),
 marks as (select doc_id, string_agg(a || '-' || b, ';' order by a) as removed from (select doc_id, min(i) as a, max(i) + 1 as b from spans where gone group by doc_id, grp) group by 1),
 left_over as (select doc_id, string_agg(tok, '' order by i) filter (not gone) as body, count(*) filter (gone) as removed_words from kept group by 1)
 select d.doc_id, case when m.removed is null then d.text when l.body is null then '' else regexp_extract(d.text, '^[\\x20\\x09-\\x0D]*') || l.body end as text,
  cast(len(d.t) as bigint) as n_words, coalesce(l.removed_words, 0) as removed_words, coalesce(m.removed, '') as removed from d left join left_over l using (doc_id) left join marks m using (doc_id)"""

_SEEDS = " union all ".join(f"select {{0}}, p, {k} as m, [" + ", ".join(f"t[p + {o + 1}]" for o in m) + f"] as s from {{1}} where p + {m[-1]} < n" for k, m in enumerate(decontam.MASKS))
_TOKENS = "list_filter(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: w <> '')"

# Seeds are token lists, each place is compared token by token, a part scores as its best stretch.  Items here have SPAN tokens and more.
OP5 = f"""with it as (select item_id, t, len(t) as n, unnest(range(len(t))) as p from (select item_id, {_TOKENS} as t from benchmark)), d as (select doc_id, t, len(t) as n, unnest(range(len(t))) as p from (select doc_id, {_TOKENS} as t from documents)),
 si as ({_SEEDS.format('item_id', 'it')}), sd as ({_SEEDS.format('doc_id', 'd')}),
 hit as (select distinct doc_id, item_id, sd.p - si.p as place from sd join si using (m, s)),
 cmp as (select h.doc_id, h.item_id, h.place, it.p, it.n, coalesce(d.t[h.place + it.p + 1] = it.t[it.p + 1] and h.place + it.p >= 0, false) as same from hit h join it using (item_id) join (select distinct doc_id, t from d) d using (doc_id)),
 cum as (select *, sum(case when same then 1 else -2 end) over (partition by doc_id, item_id, place order by p) as c from cmp),
 low as (select *, least(0, coalesce(min(c) over (partition by doc_id, item_id, place order by p rows between unbounded preceding and 1 preceding), 0)) as l from cum),
 got as (select doc_id, item_id, place, count(*) filter (same) as matched, count(*) as item_tokens, greatest(0, max(c - l)) as part_score from low group by 1, 2, 3),
 ok as (select *, row_number() over (partition by doc_id, item_id order by matched desc, part_score desc, place) as rn from got where matched >= case when item_tokens < 8 then 1.0 else {decontam.ITEM_SHARE} end * item_tokens or part_score >= {decontam.PART_SCORE})
 select doc_id, item_id, matched, item_tokens, cast(part_score as bigint) as part_score, place from ok where rn = 1"""

# Turns in order take the window before them while they fit; the lead and what fits of two turns of history open the next one.
OP8 = f"""with recursive a as (select conv_id, turn, role, coalesce(text, '') as text from conversations union all select -7, 0, 'user', '\\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
 t as (select *, len(regexp_extract_all(text, '{_WORD}')) as k, {len(chat.NEW) + 1 + len(chat.END)} + length({_ESC.format('text')}) + length({_ESC.format('role')}) as size, row_number() over (partition by conv_id order by turn, role, text) as place from a),
 l as (select t.*, f.k as lead_k, f.size as lead_size, coalesce(t.place > 1 and f.k + t.k <= {chat.BUDGET}, false) as lead from t left join t f on f.conv_id = t.conv_id and f.place = 1 and f.role = '{chat.SYSTEM}'),
 h as (select l.*, coalesce(p.k, 0) as k1, coalesce(q.k, 0) as k2, coalesce(p.size, 0) as s1, coalesce(q.size, 0) as s2, least({chat.HISTORY_TOKENS}, {chat.BUDGET} - l.k - case when l.lead then l.lead_k else 0 end) as room, p.k is not null as has1, q.k is not null as has2
  from l left join t p on p.conv_id = l.conv_id and p.place = l.place - 1 and not (p.place = 1 and p.role = '{chat.SYSTEM}') left join t q on q.conv_id = l.conv_id and q.place = l.place - 2 and not (q.place = 1 and q.role = '{chat.SYSTEM}')),
 o as (select *, has1 and k1 <= room as one, has1 and k1 <= room and has2 and k1 + k2 <= room as two from h),
 g as (select *, case when lead then lead_k else 0 end + case when one then k1 else 0 end + case when two then k2 else 0 end as head_k, case when lead then lead_size else 0 end + case when one then s1 else 0 end + case when two then s2 else 0 end as head_size from o),
 w as (select conv_id, place, place as first, k as used from g where place = 1
  union all select g.conv_id, g.place, case when (g.place - 1) % {chat.BLOCK} = 0 or w.used + g.k > {chat.BUDGET} then g.place else w.first end, case when (g.place - 1) % {chat.BLOCK} = 0 or w.used + g.k > {chat.BUDGET} then g.head_k + g.k else w.used + g.k end from w join g on g.conv_id = w.conv_id and g.place = w.place + 1)
 select g.conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by g.place)) as turns_sha256, cast(coalesce(sum(length(text)) filter (role = '{chat.TARGET}'), 0) as bigint) as loss_chars,
 sha256(coalesce(string_agg(text, '' order by g.place) filter (role = '{chat.TARGET}'), '')) as loss_sha256, cast(sum(size + case when w.first = g.place then head_size else 0 end) as bigint) as formatted_chars from g join w on w.conv_id = g.conv_id and w.place = g.place group by g.conv_id"""

_BARE = "regexp_replace(regexp_replace(lower(coalesce(url, '')), '^[a-z][a-z0-9+.-]*://', ''), '#.*$', '')"

OP10 = f"""with p as (select page_id, url, coalesce(html, '') as h, sha256(coalesce(html, '')) as payload_digest, octet_length(encode(coalesce(html, ''))) as payload_bytes, {_BARE} as u from pages),
 f as (select *, min(page_id) over (partition by payload_digest) as first, regexp_replace(regexp_replace(regexp_extract(u, '^[^/?]*'), ':\\d+$', ''), '^www\\d*\\.', '') as host, regexp_extract(u, '^[^/?]*(.*)$', 1) as rest from p),
 g as (select *, array_to_string(list_reverse(string_split(host, '.')), ',') || ')' || case when rest = '' then '/' else rest end as url_key, strftime(to_timestamp(1704067200 + page_id) at time zone 'UTC', '%Y-%m-%dT%H:%M:%SZ') as captured_at, payload_bytes >= {warc.REVISIT_BYTES} and first <> page_id as again from f)
 select page_id, payload_bytes, payload_digest, case when again then 'revisit' else 'response' end as record_type, case when again then first end as refers_to, url_key, captured_at, row_number() over (order by url_key, captured_at, page_id) - 1 as position from g"""

# Every document's own count of every term an item asks for, and all pairs that share one scored by themselves.
_TERMS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
OP11 = f"""with d as (select row_number() over () as r, doc_id, {_TERMS} as t from documents), s as (select count(*) filter (len(t) > 0) as docs, sum(len(t))::bigint as terms from d),
 q as (select distinct item_id, unnest({_TERMS}) as term from benchmark),
 p as (select r, term, count(*) as tf from (select r, unnest(t) as term from d) where term in (select term from q) group by 1, 2),
 w as (select term, cast(floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)::double)) as bigint) as w from (select term, count(*) as df from p group by 1), s),
 m as (select r, doc_id, 50 + ((50 * len(t) * docs) // terms) as m from d, s where len(t) > 0),
 c as (select item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::bigint as score from q join p using (term) join w using (term) join m using (r) group by 1, 2, 3),
 k as (select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id nulls last) as integer) as rank, doc_id, score from c where score > 0)
 select item_id, rank, doc_id, score from k where rank <= {ranked.TOP}"""

# Prefixes as lists of turns; every node meets the prefixes of its smallest member for the sums over subtrees.  CRC32 bit by bit.
_CRC = "xor(list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(string_split(c::varchar, ''), lambda ch: [ascii(ch)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda a, x: case when x >= 0 then xor(a, x) when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end), 4294967295)"
OP13 = f"""with t as (select conv_id as c, struct_pack(r := coalesce(role, ''), x := coalesce(text, '')) as said, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as pos from conversations where conv_id is not null),
 o as (select c, list(said order by pos) as own from t group by c), h as (select c, own, {_CRC} % {trie.HEADS} as h from o),
 b as (select h.c, list_concat(coalesce(f.own[1:h.h], []), h.own[h.h + 1:]) as turns from h left join o f on f.c = h.c - h.c % {trie.FAMILY}),
 m as (select c, len(turns) as n, unnest(range(len(turns) + 1)) as depth, turns from b), p as (select c, n, depth, turns[1:depth] as pre from m),
 g as (select pre, depth, min(c) as conv_id, count(*) as n_convs, sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (n = depth), '')) as ends_sha256, (count(*) - 1) * case when depth = 0 then 0 else octet_length(encode(pre[depth].x)) end as own from p group by 1, 2),
 e as (select g.*, u.conv_id as parent_conv_id from g left join g u on u.depth = g.depth - 1 and u.pre = g.pre[1:g.depth - 1] and g.depth > 0),
 k as (select parent_conv_id, depth - 1 as depth, count(*) as n_children from e where depth > 0 group by 1, 2),
 f as (select e.*, coalesce(n_children, 0) as n_children from e left join k on k.parent_conv_id = e.conv_id and k.depth = e.depth),
 s as (select a.conv_id, a.depth, count(*) filter (x.n_children = 0) as n_leaves, sum(x.own)::bigint as saved_tokens from f x join p on p.c = x.conv_id and p.depth <= x.depth join f a on a.depth = p.depth and a.pre = p.pre group by 1, 2)
 select conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 from f join s using (conv_id, depth)"""

ORACLE_SQL = {"op3_line_dedup": OP3, "op5_benchmark_decontamination": OP5, "op8_chat_formatting": OP8, "op10_warc": OP10, "op11_ranked_search": OP11, "op13_conversation_trie": OP13}
