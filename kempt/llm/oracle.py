"""The results of the queries of this package in SQL, where SQL can express them."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# Base 32 writes 160 bits as 32 digits of 5 bits: here from the hexadecimal digits, 4 of 5 bits from 5 of 4 bits.
ORACLES["op1_warc"] = """
with pages_ as (
  select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as sha from pages
), leaders as (
  select sha, min(page_id) as leader from pages_ group by sha
)
select page_id, cast(strlen(html) as bigint) as payload_bytes,
  list_aggregate(list_transform(range(32), lambda i:
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + cast(
      (cast('0x' || substr(sha, cast(i // 4 * 5 + 1 as bigint), 5) as bigint) >> cast(15 - i % 4 * 5 as integer)) & 31 as bigint)]),
    'string_agg', '') as payload_digest,
  case when page_id = leader then 'response' else 'revisit' end as record_type,
  case when page_id <> leader then leader end as refers_to
from pages_ join leaders using (sha)
"""

ORACLES["op10_jaccard_join"] = """
with recursive words as materialized (
  select doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'),
    lambda w: w <> '') as w
  from documents
), shingles as materialized (
  select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s
  from words
), sizes as materialized (
  select doc_id, count(*) as n from shingles group by doc_id
), shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as m
  from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2
), links as materialized (
  select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * m >= 75 * (x.n + y.n - m)
), sides as materialized (
  select a, b from links union all select b, a from links
), reach(node, other) as (
  select a, a from sides union select node, b from reach join sides on a = other
)
select d.doc_id, coalesce(n, 0) as n_shingles,
  coalesce((select min(other) from reach where node = d.doc_id), d.doc_id) as component_id
from documents d left join sizes using (doc_id)
"""
