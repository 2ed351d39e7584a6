"""Comparison SQL for DuckDB."""

from tenderlake.llm import licenses

TOPK = """
with v as (
    select vec_id, [cast(floor(1024 * cast(x as double)) as bigint) for x in embedding] as w
    from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), pairs as (
    select q.vec_id as query_id, c.vec_id,
        cast(list_sum([q.w[i] * c.w[i] for i in range(1, len(q.w) + 1)]) as bigint) as score
    from v q join v c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id
), ranked as (
    select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from pairs
)
select query_id, cast(rank as integer) as rank, vec_id, score from ranked where rank <= 10
"""

_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + cast((cast('0x' || substr(hex, {5 * (i // 4) + 1}, 5) as bigint) >> {15 - 5 * (i % 4)}) & 31 as integer), 1)"
    for i in range(32)
)
WARC = f"""
with p as (
    select page_id, cast(strlen(coalesce(html, '')) as bigint) as payload_bytes, sha1(coalesce(html, '')) as hex from pages
), h as (select hex, max(page_id) as holder from p group by hex)
select p.page_id, payload_bytes, {_BASE32} as payload_digest,
    case when page_id = holder then 'response' else 'revisit' end as record_type,
    case when page_id <> holder then holder end as refers_to
from p join h using (hex)
"""

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
DECONTAMINATION = f"""
with d as (select doc_id, {_WORDS} as w from documents),
b as (select item_id, {_WORDS} as w from benchmark),
windows as (
    select distinct item_id, size, array_to_string(w[i:i + size - 1], ' ') as run
    from (select *, unnest(range(1, len(w) - size + 2)) as i from (select *, least(len(w), 10) as size from b where len(w) > 0))
),
sizes as (select distinct size from windows),
runs as (
    select doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') as run
    from (select doc_id, w, size, unnest(range(1, len(w) - size + 2)) as i from d, sizes where len(w) >= size)
),
hits as (select doc_id, i, r.size, item_id from runs r join windows using (size, run)),
places as (select distinct doc_id, unnest(range(i, i + size)) as place from hits),
n as (select doc_id, count(*) as n_hit from places group by doc_id),
t as (
    select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
    from (select distinct doc_id, cast(item_id as varchar) as item from hits) group by doc_id
)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
    cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(items, '')) as items_sha256,
    coalesce(n_hit, 0) > 0 as contaminated
from d left join n using (doc_id) left join t using (doc_id)
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
DIVERGENCE = rf"""
with d as (select coalesce(lang, '') as lang, coalesce(source, '') as source, {_LOWER} as text, row_number() over () as id from documents),
w as (select lang, source, id, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
kept as (select lang, term, count(*) as lang_n from w group by all having count(distinct id) >= 10),
size as (select lang, count(*) as v, sum(lang_n) as total from kept group by lang),
c as (select lang, source, term, count(*) as n from w semi join kept using (lang, term) group by all),
g as (select lang, source, coalesce(sum(n), 0) as total from (select distinct lang, source from d) left join c using (lang, source) group by all),
cells as (
    select g.lang, g.source, term, coalesce(c.n, 0) as n,
        1 + (1000000000::hugeint * (coalesce(c.n, 0) + 2)) // (g.total + 2 * s.v) as p,
        1 + (1000000000::hugeint * (k.lang_n + 2)) // (s.total + 2 * s.v) as q
    from g join size s using (lang) join kept k using (lang) left join c using (lang, source, term)
),
sums as (
    select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
    from cells a join cells b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
),
found as (
    select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0) as value
    from g a join g b on a.lang = b.lang and a.source <> b.source
    left join sums s on a.lang = s.lang and a.source = s.source and b.source = s.item
    union all
    select lang, source, 'term', term, (p - q) * (p - q) // (p + q) from cells where n > 0 and p > q
),
ranked as (select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from found)
select lang, source, part, item, cast(value as bigint) as value, cast(rank as integer) as rank from ranked where part = 'pair' or rank <= 10
"""

LEXICAL = rf"""
with d as (select doc_id, {_LOWER} as text, row_number() over () as id from documents),
w as (select id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
tf as (select id, term, count(*) as tf from w group by all),
df as (select term, count(*) as df from tf group by term),
n as (select id, sum(tf) as n from tf group by id),
size as (select count(*) as total, sum(n) as terms from n),
m as (select id, 50 + (50 * n::bigint * total) // terms::bigint as m from n, size),
b as (select item_id, {_LOWER} as text, row_number() over () as item from benchmark),
asked as (select distinct item, item_id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from b),
weighed as (select a.*, cast(floor(1000 * ln((2 * total + 2)::double / (2 * df + 1)::double)) as bigint) as weight from asked a join df using (term), size),
scored as (
    select item, item_id, id, sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * m))) as score
    from weighed join tf using (term) join m using (id) group by all
),
ranked as (
    select item_id, doc_id, score, row_number() over (partition by item order by score desc, doc_id nulls last) as rank
    from scored join d using (id) where score > 0
)
select item_id, cast(rank as integer) as rank, doc_id, cast(score as bigint) as score from ranked where rank <= 50
"""

SHARDING = """
with d as (
    select doc_id, cast(strlen(coalesce(text, '')) as bigint) as bytes,
        substr(to_binary_text, length(to_binary_text) - 59, 60) as bits
    from (select *, bin(cast('0x' || substr(md5(cast(doc_id as varchar)), 1, 15) as bigint) | (1::bigint << 60)) as to_binary_text from documents)
),
prefixes as (select doc_id, bytes, depth, substr(bits, 1, depth) as shard from d, (select unnest(range(0, 61)) as depth)),
fitting as (select shard, depth from prefixes group by shard, depth having sum(bytes) <= 1048576 or count(*) = 1)
select doc_id, any_value(bytes) as bytes, min(shard) as shard, cast(min(depth) as integer) as depth
from prefixes join fitting using (shard, depth) group by doc_id
"""


def _template_rows() -> str:
    rows = []
    for t in [*licenses.PHRASES, *licenses.NOTICES]:
        words = ", ".join(f"'{w}'" for w in t.words)
        rows.append(f"('{t.label}', '{t.family}', [{words}], {t.needed}, {str(t.phrase).lower()})")
    return ", ".join(rows)


LICENSES = f"""
with d as (select doc_id, {_WORDS} as w from documents),
t(label, family, words, needed, phrase) as (values {_template_rows()}),
blocks as (select doc_id, i, w[i + 1:i + 64] as here from (select *, unnest(range(0, len(w), 32)) as i from d)),
met as (
    select doc_id, i, here, t.*, list_intersect(list_distinct(words), here) as common, len(list_intersect(list_distinct(words), here)) as shared,
        len(list_distinct(words)) as size
    from blocks join t on len(list_intersect(list_distinct(words), here)) >= needed
),
placed as (
    select *, case when phrase then list_filter(range(1, least(32, len(here)) + 1), lambda p: here[p:p + len(words) - 1] = words) else [] end as starts
    from met
),
held as (select *, shared / size as contained, row_number() over () as at from placed where not phrase or len(starts) > 0),
best as (
    select * from held x where not exists (
        select 1 from held y where y.doc_id = x.doc_id and y.i = x.i and y.family = x.family and y.contained > x.contained
            and len(list_intersect(x.common, y.common)) = len(x.common)
    )
),
labels as (
    select doc_id, sum(len(starts)) as n_base, min(i + list_min(starts) - 1) as first_word, max(i + list_max(starts) - 1) as last_word,
        string_agg(distinct label, ',' order by label) filter (where phrase) as base_labels,
        string_agg(distinct label, ',' order by label) as labels, max(contained) as score
    from best group by doc_id
)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_base, 0) as bigint) as n_base, first_word, last_word,
    coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0.0) as score
from d left join labels using (doc_id)
"""
