"""The results of the registered queries as DuckDB SQL, where SQL can state them."""

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

TRACKING = "('fbclid', 'gclid', 'ref', 'utm_campaign', 'utm_content', 'utm_medium', 'utm_source', 'utm_term')"

ORACLE_SQL = {
    "op6_warc_revisits": rf"""
with bare as (
    select *, regexp_replace(regexp_replace(coalesce(url, ''), '#.*$', '', 's'), '^[A-Za-z][A-Za-z0-9+.-]*://', '') as b,
        (page_id * 7919 % 100003) * 60 as s, substring(md5(coalesce(html, '')), 1, 16) as tag
    from pages),
keyed as (
    select *, strftime(timestamp '2020-09-13 12:26:40' + to_seconds(s), '%Y-%m-%d %H:%M:%S') as lm,
        strlen(html) as len, list_sort(list_filter(string_split(regexp_extract(b, '^[^?]*\?(.*)$', 1, 's'), '&'),
            lambda p: p <> '' and split_part(p, '=', 1) not in {TRACKING})) as q
    from bare),
named as (
    select *, regexp_replace(translate(regexp_extract(b, '^[^/?]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '^www\.|:(80|443)$', '', 'g') || regexp_replace(regexp_extract(b, '^[^/?]*([^?]*)', 1), '/+$', '')
        || case when len(q) > 0 then '?' || array_to_string(q, '&') else '' end as k
    from keyed),
latest as (
    select r.page_id, max(row(f.s, f.page_id)) as f from named r join named f on f.k = r.k and f.s < r.s + 86400 group by 1),
asked as (
    select r.*, f.page_id as sp, f.tag as stag, f.lm as slm, f.len as slen, f.html as sh,
        case when r.page_id % 11 = 0 or r.page_id % 5 = 0 then null when r.page_id % 7 = 0 then 'other' else 'W/' || r.tag end
            as rtag,
        case when r.page_id % 11 = 0 then null else r.lm end as rlm
    from named r left join latest l on l.page_id = r.page_id left join named f on f.page_id = l.f[2]),
judged as (
    select *, case when sp is null then 'orphan' when rtag is not null then if(replace(rtag, 'W/', '') = stag, 'resolved', 'mismatch')
        when rlm is not null then if(rlm = slm, 'resolved', 'mismatch') else 'unverified' end as outcome from asked)
select page_id * 2 as record_id, k as url_key, 'full' as outcome, cast(null as bigint) as source,
    'cache-control: max-age=60' || coalesce(chr(10) || 'content-length: ' || len, '') || chr(10) || 'content-type: text/html'
        || chr(10) || 'etag: ' || tag || chr(10) || 'last-modified: ' || lm as headers, sha256(html) as body_sha256
from named
union all
select page_id * 2 + 1, k, outcome, case when outcome = 'resolved' then sp * 2 end,
    case when outcome = 'resolved' then 'cache-control: max-age=600' || coalesce(chr(10) || 'content-length: ' || slen, '')
        || chr(10) || 'content-type: text/html' || chr(10) || 'etag: ' || stag || chr(10) || 'last-modified: ' || coalesce(rlm, slm)
    else 'cache-control: max-age=600' || chr(10) || 'content-length: 0' || coalesce(chr(10) || 'etag: ' || rtag, '')
        || coalesce(chr(10) || 'last-modified: ' || rlm, '') end,
    case when outcome = 'resolved' then sha256(sh) end
from judged
""",
    "op2_decontamination": f"""
with words as (
    select doc_id as id, {WORDS.replace("coalesce(text, '')", LOWER)} as w, false as item from documents
    union all select item_id, {WORDS.replace("coalesce(text, '')", LOWER)}, true from benchmark),
shingles as (
    select distinct id, item, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1),
        lambda i: array_to_string(w[i:i + 4], ' '))) as s
    from words where len(w) > 0),
sizes as (select id as item_id, count(*) as item_shingles from shingles where item group by id)
select d.id as doc_id, i.id as item_id, cast(count(*) as integer) as shared,
    cast(any_value(z.item_shingles) as integer) as item_shingles
from shingles d join shingles i on d.s = i.s and i.item and not d.item join sizes z on z.item_id = i.id
group by d.id, i.id having count(*) >= 0.8 * any_value(z.item_shingles)
""",
    "op4_mixing": f"""
with sized as (
    select doc_id, source, cast(len({WORDS}) as bigint) as size, md5(cast(doc_id as varchar) || ':mix-1') as k
    from documents),
totals as (
    select source, cast(sum(size) as bigint) as source_size,
        [1.0, 2.0, 3.0][cast((row_number() over (order by encode(source) nulls last) - 1) % 3 + 1 as integer)] as weight
    from sized group by source),
filled as (
    select *, 3 * source_size / weight as full_at, sum(source_size) over () as budget, sum(weight) over () as all_weights
    from totals),
levels as (
    select *, (budget - coalesce(sum(3 * source_size) over before, 0)) /
        (all_weights - coalesce(sum(weight) over before, 0)) as level
    from filled window before as (order by full_at, source rows between unbounded preceding and 1 preceding)),
target as (
    select source, source_size, cast(least(3 * source_size, weight * coalesce(
        (select level from levels where level <= full_at order by full_at limit 1), 'infinity'::double)) as double)
        as target
    from levels),
queued as (
    select doc_id, size, source_size, target, coalesce(sum(size) over (
        partition by s.source order by k, doc_id rows between unbounded preceding and 1 preceding), 0) as b
    from sized s join target t on s.source is not distinct from t.source)
select doc_id, size, source_size, target, cast(
    greatest(0, least(size, floor(target + 0.5) - b)) + greatest(0, least(size, floor(target + 0.5) - b - source_size))
    + greatest(0, least(size, floor(target + 0.5) - b - 2 * source_size)) as bigint) as taken
from queued
""",
    "op5_exact_dedup": f"""
with hashed as (select doc_id, {LOWER} as t, sha256({LOWER}) as text_sha256 from documents)
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
    doc_id = max(doc_id) over same as kept, text_sha256
from hashed window same as (partition by t)
""",
    "op10_suffix_dedup": """
with bytes as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
windows as (
    select doc_id, unnest(range(0, cast(length(h) / 2 - 49 as bigint))) as p,
        substring(h, 2 * p + 1, 100) as s
    from bytes where length(h) >= 100),
firsts as (select s, min(doc_id) as low from windows group by s having min(doc_id) < max(doc_id)),
hits as (select w.doc_id, w.p from windows w join firsts f on w.s = f.s and w.doc_id > f.low),
edges as (
    select doc_id, p, case when p <= max(p + 50) over (
        partition by doc_id order by p rows between unbounded preceding and 1 preceding) then 0 else 1 end as fresh
    from hits),
runs as (select doc_id, p, sum(fresh) over (partition by doc_id order by p) as run from edges),
spans as (select doc_id, run, min(p) as a, max(p) + 50 as b from runs group by doc_id, run),
gaps as (
    select s.doc_id, b as a, coalesce(lead(s.a) over (partition by s.doc_id order by s.a), length(h) / 2) as b
    from spans s join bytes using (doc_id)
    union all select doc_id, 0, min(a) from spans group by doc_id),
left_over as (
    select doc_id, coalesce(string_agg(substring(h, cast(2 * a + 1 as bigint), cast(2 * (b - a) as bigint)), '' order by a), '') as k
    from gaps join bytes using (doc_id) group by doc_id),
sums as (select doc_id, sum(b - a) as n_removed, count(*) as n_spans from spans group by doc_id)
select b.doc_id, cast(length(h) / 2 as bigint) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed,
    cast(coalesce(n_spans, 0) as bigint) as n_spans, sha256(unhex(coalesce(k, h))) as kept_sha256
from bytes b left join sums using (doc_id) left join left_over using (doc_id)
""",
    "op7_substring_dedup": f"""
with words as (select doc_id, {WORDS} as w from documents),
windows as (
    select doc_id, unnest(range(1, len(w) - 11)) as p, unnest(list_transform(range(1, len(w) - 11),
        lambda i: array_to_string(w[i:i + 12], ' '))) as s
    from words where len(w) >= 13),
firsts as (select s, min(doc_id) as low from windows group by s having min(doc_id) < max(doc_id)),
removed as (
    select distinct w.doc_id, unnest(range(w.p, w.p + 13)) as i from windows w join firsts f on w.s = f.s and w.doc_id > f.low),
each as (select doc_id, unnest(range(1, len(w) + 1)) as i, unnest(w) as word from words),
kept as (
    select e.doc_id, string_agg(word, ' ' order by e.i) as k, count(*) as n
    from each e anti join removed r on e.doc_id = r.doc_id and e.i = r.i group by e.doc_id)
select doc_id, len(w) as n_words, len(w) - coalesce(n, 0) as n_removed, sha256(coalesce(k, '')) as kept_sha256
from words left join kept using (doc_id)
""",
}


def _field(value: str) -> str:
    return f"coalesce(strlen(cast({value} as varchar)) || ':' || {value}, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", text))) + ")"


def _climb(start: str, first: str, levels: int = 6) -> str:
    """CTEs that take nodes (tree, i, d) up to one node per tree, runs of 16 on each level; ``start`` names the leaves."""
    out, last = [], start
    for level in range(levels):
        out.append(f"""
{first}r{level} as (
    select tree, i // 16 as i, list(d order by i) as run, count(*) over (partition by tree) as runs, any_value(n) as n
    from (select *, count(*) over (partition by tree) as n from {last}) group by tree, i // 16),
{first}n{level} as (select tree, i, if(n = 1, run[1], sha256(array_to_string(run, ''))) as d from {first}r{level})""")
        last = f"{first}n{level}"
    return ",".join(out)


def _ways(frm: str, own: str, first: str, levels: int = 6) -> str:
    """CTEs that extend ``frm`` (doc_id, tree, i, proof, folded) level by level; ``own`` is that CTE's name."""
    out, last = [], frm
    for level in range(levels):
        at = "cast(w.i % 16 as bigint)"
        out.append(f"""
{own}{level} as (
    select w.doc_id, w.tree, w.i // 16 as i,
        if(r.n = 1, proof, proof || array_to_string(r.run[:{at}], '') || array_to_string(r.run[{at} + 2:], '')) as proof,
        if(r.n = 1, folded, sha256(array_to_string(r.run[:{at}], '') || folded || array_to_string(r.run[{at} + 2:], ''))) as folded
    from {last} w join {first}r{level} r on r.tree is not distinct from w.tree and r.i = w.i // 16)""")
        last = f"{own}{level}"
    return ",".join(out)


#: CRC-32 of the decimal doc_id, bit by bit over its digits: DuckDB has no function for it.
_CRC = """list_reduce(list_prepend(4294967295::ubigint, list_transform(string_split(cast(doc_id as varchar), ''), lambda c: ord(c)::ubigint)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0::ubigint, 1, 2, 3, 4, 5, 6, 7]),
        lambda x, k: if(x % 2 = 1, xor(x // 2, 3988292384::ubigint), x // 2)))"""

ORACLE_SQL["op12_merkle_manifest"] = f"""
with leaves as (
    select doc_id, source, {_leaf("text")} as leaf, {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} as low,
        xor({_CRC}, 4294967295::ubigint) % 5 = 0 as tampered
    from documents),
placed as (
    select doc_id, source as tree, leaf as d, if(coalesce(tampered, false), low, leaf) as claimed,
        row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as i
    from leaves),
{_climb("placed", "s")},
subroots as (
    select 1 as tree, tree as source, d, row_number() over (order by encode(tree) nulls first) - 1 as i from sn5),
{_climb("subroots", "t")},
w as (select doc_id, tree, i, '' as proof, claimed as folded from placed),
{_ways("w", "a", "s")},
v as (select doc_id, s.tree, s.i, proof, folded from a5 join subroots s on s.source is not distinct from a5.tree),
{_ways("v", "b", "t")}
select p.doc_id, p.d as leaf, s.d as subroot, r.d as root, sha256(proof) as proof_sha256, folded as folded_root, folded = r.d as verified
from placed p join b5 on b5.doc_id is not distinct from p.doc_id join subroots s on s.source is not distinct from p.tree cross join tn5 r
"""

MARKS = ("<|turn|>", "<|says|>", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>")


def _escaped_length(text: str) -> str:
    """Length of an escaped text: one more for each backslash, two more for each control string."""
    marks = " + ".join(f"2 * (length({text}) - length(replace({text}, '{m}', ''))) // {len(m)}" for m in MARKS)
    return rf"length({text}) + (length({text}) - length(replace({text}, '\', ''))) + {marks}"


ORACLE_SQL["op11_chat_format"] = rf"""
with told as (
    select distinct conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
by_conversation as (
    select conv_id, count(*) as n_turns,
        string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, md5(text)) as turns,
        coalesce(string_agg(text, '' order by turn nulls first, role, md5(text)) filter (role = 'assistant'), '') as trained,
        sum({len("<|turn|><|says|></s>")} + {_escaped_length("role")} + {_escaped_length("text")}) as formatted_chars
    from told group by conv_id)
select conv_id, n_turns, sha256(turns) as turns_sha256, cast(length(trained) as bigint) as loss_chars, sha256(trained) as loss_sha256,
    cast(formatted_chars as bigint) as formatted_chars
from by_conversation
"""

ORACLE_SQL["op13_collocations"] = rf"""
with pieces as (
    select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array({LOWER}, '[.,;:!?\x0A-\x0D]')) as piece from documents),
words as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
grams as (
    select lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) as g
    from words, (values (1), (2), (3)) as t(k) where len(w) >= k),
f as (select lang, any_value(k) as k, g, count(*) as c from grams group by lang, g),
totals as (select lang, cast(sum(c) as bigint) as n from f where k = 1 group by lang),
often as materialized (select * from f where c >= 10),
candidates as materialized (select lang, k, g, c as a, string_split(g, ' ') as w from often where k > 1),
parts as materialized (
    select lang, g, a, k, j, array_to_string(w[:j], ' ') as head, array_to_string(w[j + 1:], ' ') as rest
    from candidates, (values (1), (2)) as t(j) where j < k),
cuts as (
    select x.lang, x.g, x.a, j, l.c as l, r.c as r,
        cast((1000000::hugeint * x.a * x.a) // (l.c::hugeint * r.c) as bigint) as score
    from parts x join often l on l.lang = x.lang and l.g = x.head join often r on r.lang = x.lang and r.g = x.rest),
scored as (select lang, g, any_value(a) as a, min(row(score, j, l, r)) as best from cuts group by lang, g),
longer as (
    select lang, s, max(a) as a from (
        select lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) as s from candidates where k = 3)
    group by lang, s),
kept as (
    select s.lang, s.g as phrase, s.a, best[3] as l, best[4] as r, best[1] as score
    from scored s left join longer o on o.lang = s.lang and o.s = s.g where o.a is null or 100 * o.a < 50 * s.a),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select lang, rank, phrase, a, l, r, n, score from ranked join totals using (lang) where rank <= 2000
"""
