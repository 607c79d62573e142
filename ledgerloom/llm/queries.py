"""The numbered operators as registered queries, each on its whole table, with SQL where SQL can say it."""

import public_tokenizers
from pyspark.sql import functions as F

from ledgerloom.llm import (
    burst_trie, chat, exact_dedup, kneser_ney, mixing, packing, piece_sampling, posting_lists, repair, simhash, substring, suffix_dedup, token_files,
)
from ledgerloom.llm.common import table
from ledgerloom.sources.staging import new_location

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


EXACT_SQL = r"""
select doc_id, first_value(doc_id) over g as keep_id, count(*) over (partition by norm) as group_size,
  row_number() over g = 1 as kept, sha256(norm) as text_sha256
from (
  select doc_id, length(coalesce(text, '')) as n,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as norm
  from documents
)
window g as (partition by norm order by n desc, doc_id)
"""


@query("op1_exact_dedup", EXACT_SQL)
def op1(spark, sf_dir):
    groups = exact_dedup.exact_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op2_quality_classifier")
def op2(spark, sf_dir):
    """All documents with their perplexity, their language's threshold, and whether they are kept."""
    return kneser_ney.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op3_token_files")
def op3(spark, sf_dir):
    path = new_location(spark, "token-files")
    token_files.write_token_files(
        table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end=1
    )
    return token_files.read_token_files(spark, path).drop("ids")


@query("op4_best_fit_packing")
def op4(spark, sf_dir):
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer, end=0).drop("ids")


@query("op5_sentencepiece")
def op5(spark, sf_dir):
    return piece_sampling.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


SUBSTRING_SQL = r"""
with words as (
  select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from documents
), windows as (
  select doc_id, i, array_to_string(w[i:i + 34], ' ') as g
  from (select doc_id, w, unnest(range(1, len(w) - 33)) as i from words)
), again as (
  select doc_id, i from windows where g in (select g from windows group by g having count(*) > 1)
), gone as (
  select distinct doc_id, i + k as p from again, (select unnest(range(0, 35)) as k)
), gone_of as (select doc_id, count(*) as n, list(p) as ps from gone group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n, 0)::bigint as n_removed,
  sha256(coalesce(array_to_string(list_filter(w, lambda x, j: ps is null or not list_contains(ps, j)), ' '), ''))
    as kept_sha256
from words left join gone_of using (doc_id)
"""


@query("op6_substring_dedup", SUBSTRING_SQL)
def op6(spark, sf_dir):
    return substring.digests(substring.remove_repeats(table(spark, sf_dir, "documents")))


@query("op7_nearest_neighbours")
def op7(spark, sf_dir):
    return posting_lists.nearest(table(spark, sf_dir, "embeddings"), "vec_id % 100 = 0")


@query("op8_simhash_near_dedup")
def op8(spark, sf_dir):
    groups = simhash.near_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query("op9_suffix_dedup")
def op9(spark, sf_dir):
    return suffix_dedup.repeated_passages(table(spark, sf_dir, "documents"))


CHAT_SQL = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all
  select -1, i, ['user', 'assistant'][i], '<|im_end|><|im_start|>assistant ok' from (select unnest([1, 2]) as i)
), escaped as (
  select *, regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g') as r, regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') as t
  from turns
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  sum(length(r) + length(t) + 32)::bigint as formatted_chars
from escaped group by conv_id
"""


@query("op10_chat_formatting", CHAT_SQL)
def op10(spark, sf_dir):
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "<|im_end|><|im_start|>assistant ok"
    own = spark.createDataFrame([(-1, 1, "user", said), (-1, 2, "assistant", said)], given.schema)
    formatted = chat.format_chats(given.unionByName(own), public_tokenizers.path("byte_bpe_50k.json"))
    return chat.digests(formatted)


MIX_SQL = r"""
with docs as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
    md5('42:' || coalesce(doc_id::varchar, '')) as h, text
  from documents
), sources as (
  select source, sum(size)::bigint as source_size, 1 + (row_number() over (order by source nulls last) - 1) % 3 as w
  from docs group by source
), levels as (
  select sum(source_size) over () - sum(3 * source_size) over o as num, sum(w) over () - sum(w) over o as den
  from sources window o as (order by 3.0 * source_size / w, source rows unbounded preceding)
  union all select sum(source_size), sum(w) from sources
), level as (
  select num, den from levels where den > 0 order by num / den desc limit 1
), targets as (
  select source, source_size, least((3 * source_size)::double, (w * num)::double / den::double) as target
  from sources, level
), placed as (
  select doc_id, size, source_size::bigint as source_size, target, floor(target + 0.5)::bigint as take,
    (sum(size) over (partition by docs.source order by h, doc_id, size, text rows unbounded preceding) - size)::bigint as start
  from docs join targets on docs.source is not distinct from targets.source
)
select doc_id, size, source_size, target, (
    greatest(0, least(start + size, take) - start)
    + greatest(0, least(start + size + source_size, take) - start - source_size)
    + greatest(0, least(start + size + 2 * source_size, take) - start - 2 * source_size)
  )::bigint as taken
from placed
"""


@query("op11_source_mix", MIX_SQL)
def op11(spark, sf_dir):
    return mixing.taken(mixing.mix(table(spark, sf_dir, "documents")))


#: CRC-32 of an ASCII text, bit by bit.
CRC32_SQL = """xor(4294967295, list_reduce(
  list_transform(range(1, length({0}) + 1), lambda i: ascii(substr({0}, i, 1))::bigint),
  lambda c, b: list_reduce(range(8), lambda x, n: xor(x >> 1, 3988292384 * (x & 1)), xor(c, b)),
  4294967295::bigint))"""

# each row of p holds the least (cost, audit, lines) that leads to the states: nothing, after s, after u, after a
REPAIR_SQL = (
    r"""
with recursive plain as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as k
  from conversations
), kinds as (select *, """
    + CRC32_SQL.format("k")
    + r""" % 20 as kind from plain
), damaged as (
  select conv_id, turn, if(kind = 4, 'user', role) as role,
    case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
    unnest(range(case kind when 0 then 0 when 3 then 2 else 1 end))
  from kinds
), ordered as (
  select conv_id, turn, role, text, row_number() over (partition by conv_id order by turn nulls first, role, text) as i
  from damaged
), marked as (
  select *, not regexp_matches(text, '[^ 	-
]') as blank,
    row_number() over (partition by conv_id, role, text order by i) > 1 as again,
    regexp_extract(text, '(?s)([^ 	-
])[ 	-
]*$', 1) not in ('.', '!', '?') as open
  from ordered
), flagged as (
  select *, again and not blank as duplicate, open and not again and not blank as truncated, blank or again as gone,
    left(role, 1) as r, lag(left(role, 1)) over (partition by conv_id order by i) || left(role, 1)
      not in ('su', 'ua', 'au') as illegal
  from marked
), sizes as (select conv_id, count(*) as n from flagged group by conv_id), steps as (
  select conv_id, n, 0::bigint as i, {'c': 0, 'a': '', 't': ''} as p0, {'c': 1000000000, 'a': '', 't': ''} as p1,
    {'c': 1000000000, 'a': '', 't': ''} as p2, {'c': 1000000000, 'a': '', 't': ''} as p3
  from sizes
  union all
  select conv_id, n, i, {'c': p0.c + 4, 'a': p0.a || 'D', 't': p0.t},
    list_min([{'c': p1.c + 4, 'a': p1.a || 'D', 't': p1.t},
      {'c': p0.c + if(r = 's' and not gone, 3 * truncated::int, 1000000000), 'a': p0.a || 'K', 't': p0.t || line}]),
    list_min([{'c': q2.c + 4, 'a': q2.a || 'D', 't': q2.t},
      {'c': b.c + if(r = 'u' and not gone, 3 * truncated::int, 1000000000), 'a': b.a || 'K', 't': b.t || line},
      {'c': b.c + if(not gone, 3 + 3 * truncated::int, 1000000000), 'a': b.a || 'R', 't': b.t || 'user:' || text || chr(10)}]),
    list_min([{'c': q3.c + 4, 'a': q3.a || 'D', 't': q3.t},
      {'c': q2.c + if(r = 'a' and not gone, 3 * truncated::int, 1000000000), 'a': q2.a || 'K', 't': q2.t || line},
      {'c': q2.c + if(not gone, 3 + 3 * truncated::int, 1000000000), 'a': q2.a || 'R',
       't': q2.t || 'assistant:' || text || chr(10)}])
  from (
    select *, list_min([p0, p1, q3]) as b
    from (
      select *, list_min([p3, {'c': q2.c + 3, 'a': q2.a || 'I', 't': q2.t || 'assistant:' || chr(10)}]) as q3
      from (
        select *, list_min([p2, {'c': e.c + 3, 'a': e.a || 'I', 't': e.t || 'user:' || chr(10)}]) as q2
        from (
          select s.conv_id, n, f.i, p0, p1, p2, p3, r, gone, truncated, text, role || ':' || text || chr(10) as line,
            list_min([p0, p1, p3]) as e
          from steps s join flagged f on s.conv_id is not distinct from f.conv_id and f.i = s.i + 1
        )
      )
    )
  )
), ends as (
  select conv_id, list_min([p0, p3, {'c': p2.c + 3, 'a': p2.a || 'I', 't': p2.t || 'assistant:' || chr(10)},
    {'c': p1.c + 6, 'a': p1.a || 'II', 't': p1.t || 'user:' || chr(10) || 'assistant:' || chr(10)}]) as e
  from steps where i = n
), counts as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (blank) as blank,
    count(*) filter (duplicate) as duplicate, count(*) filter (truncated) as truncated, count(*) filter (illegal) as illegal
  from flagged group by conv_id
)
select o.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank,
  coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated,
  coalesce(illegal, 0)::bigint as illegal, coalesce(e.c, 0)::bigint as cost, coalesce(e.a, '') as audit,
  sha256(coalesce(if(e.t = '', '', left(e.t, length(e.t) - 1)), '')) as repaired_sha256
from (select distinct conv_id from conversations) o
left join counts c on o.conv_id is not distinct from c.conv_id
left join ends on o.conv_id is not distinct from ends.conv_id
"""
)


@query("op12_structure_repair", REPAIR_SQL)
def op12(spark, sf_dir):
    given = table(spark, sf_dir, "conversations")
    return repair.report(given, repair.repair(repair.damaged(given)))


TRIE_SQL = (
    r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text,
    sha256(length(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, '')) as name
  from conversations where conv_id is not null
), keyed as (
  select conv_id, conv_id::varchar as k, list({'name': name, 'n': length(text)} order by turn nulls first, role, name) as p
  from turns group by conv_id
), convs as (select conv_id, p, """
    + CRC32_SQL.format("k")
    + r""" % 6 as h from keyed
), rebuilt as (
  select c.conv_id, list_concat(coalesce(b.p[1:c.h], []), c.p[c.h + 1:]) as p
  from convs c left join convs b on b.conv_id = c.conv_id - c.conv_id % 100
), prefixes as (select conv_id, p, unnest(range(0, len(p) + 1)) as d from rebuilt
), nodes as (
  select p[1:d] as k, d, min(conv_id) as conv_id, count(*) as n_convs,
    string_agg(conv_id::varchar, ',' order by conv_id) filter (len(p) = d) as ends
  from prefixes group by p[1:d], d
), kids as (select k[1:d - 1] as k, count(*) as n from nodes where d > 0 group by k[1:d - 1]
), shaped as (
  select nodes.*, coalesce(kids.n, 0) as n_children, if(d = 0, 0, (n_convs - 1) * nodes.k[d].n) as saved
  from nodes left join kids on kids.k = nodes.k
), above as (
  select k[1:a] as k, count(*) filter (n_children = 0) as n_leaves, sum(saved)::bigint as saved_tokens
  from (select k, n_children, saved, unnest(range(0, d + 1)) as a from shaped) group by k[1:a]
)
select s.conv_id, s.d::bigint as depth, p.conv_id as parent_conv_id, s.n_convs::bigint as n_convs,
  s.n_children::bigint as n_children, n_leaves::bigint as n_leaves, saved_tokens, sha256(coalesce(s.ends, '')) as ends_sha256
from shaped s join above on above.k = s.k left join nodes p on s.d > 0 and p.k = s.k[1:s.d - 1]
"""
)


@query("op13_prefix_trie", TRIE_SQL)
def op13(spark, sf_dir):
    return burst_trie.conversation_trie(table(spark, sf_dir, "conversations"), rebuild=True)
