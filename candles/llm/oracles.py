"""DuckDB SQL of the queries that SQL can express."""

OP6 = r"""
with cut as (
  select page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path
  from pages),
rules(action, rhost, rpath) as (values
  ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
places as (select distinct host, path from cut),
fits as (
  select host, path, arg_max(rhost || rpath, length(rhost) * 100000 + length(rpath)) as rule,
         arg_max(action, length(rhost) * 100000 + length(rpath)) as action
  from places, rules
  where (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath)
  group by host, path)
select page_id, host, path, rule, coalesce(action, 'allow') as verdict
from cut left join fits using (host, path)
"""

OP4 = """
with payloads as (select page_id, coalesce(html, '') as body from pages),
hashed as (select page_id, strlen(body) as n, sha1(body) as sha from payloads),
bits as (
  select *, array_to_string(list_transform(range(40), lambda i: lpad(bin(('0x' || substr(sha, i + 1, 1))::int), 4, '0')), '') as b
  from hashed),
named as (
  select page_id, n, sha, array_to_string(list_transform(range(32), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ('0b' || substr(b, 5 * i + 1, 5))::int, 1)), '') as digest
  from bits),
firsts as (select sha, min(page_id) as first from named where page_id is not null group by sha)
select page_id, n as payload_bytes, digest as payload_digest,
       case when page_id > first then 'revisit' else 'response' end as record_type,
       case when page_id > first then first end as refers_to
from named left join firsts using (sha)
"""

OP5 = """
with recursive usable as (
  select vec_id, embedding::double[] as v from embeddings
  where embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x != 0)) > 0),
pairs as (
  select a.vec_id as a, b.vec_id as b from usable a join usable b on a.vec_id != b.vec_id and len(a.v) = len(b.v)
  where list_cosine_similarity(a.v, b.v) >= 0.95),
reach(a, b) as (select vec_id, vec_id from embeddings union select reach.a, pairs.b from reach join pairs on reach.b = pairs.a),
least as (select a as vec_id, min(b) as component_id from reach group by a),
counts as (select a as vec_id, count(*) as n from pairs group by a)
select vec_id, coalesce(n, 0) as n_links, component_id, vec_id = component_id as kept
from least left join counts using (vec_id)
"""

#: CRC-32 of half a byte.
_CRC = "[0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948, 3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108]::bigint[]"
#: The jumps of the hash as a fold over as many steps as shards.
_JUMP = """list_reduce(list_prepend({'k': coalesce(doc_id, 0)::hugeint, 'at': -1::bigint, 'go': 0::bigint},
    list_transform(range(%d), lambda i: {'k': 0::hugeint, 'at': 0::bigint, 'go': 0::bigint})),
  lambda s, x: case when s.go >= %d then s else {
    'k': (s.k * 2862933555777941757 + 1) %% 18446744073709551616, 'at': s.go,
    'go': floor((s.go + 1)::double * (2147483648.0::double /
          (((s.k * 2862933555777941757 + 1) %% 18446744073709551616 // 8589934592)::double + 1.0::double)))::bigint} end).at"""
OP8 = f"""
with sized as materialized (
  select doc_id, strlen(coalesce(text, '')) + 1 as size, string_split(hex(encode(coalesce(text, ''))), '') as digits from documents),
bytes as materialized (
  select doc_id, size, list_transform(range(2 * (size - 1)), lambda i:
           strpos('123456789ABCDEF', digits[i + 2 - 2 * (i % 2)])) as halves from sized),
summed as (
  select doc_id, size, xor(list_reduce(list_prepend(4294967295::bigint, halves), lambda c, b:
           xor(c >> 4, ({_CRC})[1 + (xor(c, b) & 15)])), 4294967295) as text_crc32
  from bytes),
placed as (select *, {_JUMP % (16, 16)} as shard, {_JUMP % (17, 17)} as grown_shard from summed)
select doc_id, size, text_crc32, 'key' as law, shard::int as shard,
       row_number() over (partition by shard order by doc_id nulls first) - 1 as slot, grown_shard::int as grown_shard
from placed
"""

OP11 = """
with whole as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id, list_dot_product(q.v, c.v)::bigint as score
  from whole q join whole c on q.vec_id % 50 = 0 and q.vec_id != c.vec_id),
ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""

_FOLDED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_FOUND = r"regexp_extract_all(%s, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')" % _FOLDED
OP12 = f"""
with docs as materialized (
  select doc_id, {_FOUND} as terms from documents where text is not null),
corpus as (select count(*) as n, sum(len(terms))::bigint as total from docs where len(terms) > 0),
asked as materialized (
  select distinct item_id, unnest({_FOUND}) as term from benchmark),
postings as materialized (
  select doc_id, len(terms) as words, term, count(*) as tf
  from (select doc_id, terms, unnest(terms) as term from docs)
  where term in (select term from asked) group by all),
weights as (
  select term, floor(1000 * ln((2 * n + 2)::double / (2 * count(*) + 1)::double))::bigint as w
  from postings, corpus group by term, n),
scored as (
  select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * words * n) // total))))::bigint as score
  from asked join postings using (term) join weights using (term), corpus group by item_id, doc_id),
ranked as (
  select *, row_number() over (partition by item_id order by score desc, doc_id)::int as rank from scored where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= 50
"""

ORACLES = {"op4_warc": OP4, "op5_collisions": OP5, "op6_url_filter": OP6, "op8_jump_hash": OP8, "op11_uniform_threshold": OP11,
           "op12_blocked_search": OP12}
