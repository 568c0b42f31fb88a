"""Query op13: the prefix trie of all conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm.registry import register, table
from strata.llm.trie import trie

# DuckDB has no crc32: its table is made by rule and the digits of each id are folded through it.
_SQL = """
with recursive steps as (
  select range as i, range::bigint as c, 0 as k from range(256)
  union all
  select i, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, k + 1 from steps where k < 8),
crc as (select list(c order by i) as t from steps where k = 8),
ids as (
  select conv_id, conv_id - conv_id % 5 as base, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(
           string_split(conv_id::varchar, ''), lambda d: ascii(d)::bigint)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])),
         4294967295::bigint) % 9 as h
  from (select distinct conv_id from conversations where conv_id is not null), crc),
own as (
  select conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} order by turn nulls first,
         coalesce(role, ''), coalesce(text, '')) as turns
  from conversations where conv_id is not null group by conv_id),
rebuilt as (
  select i.conv_id, list_concat(coalesce(b.turns[1:i.h], []), o.turns[i.h + 1:]) as turns
  from ids i join own o on o.conv_id = i.conv_id left join own b on b.conv_id = i.base),
prefixes as (
  select conv_id, d, len(turns) as length, sha256(turns[1:d]::varchar) as k,
         case when d > 0 then sha256(turns[1:d - 1]::varchar) end as pk,
         case when d > 0 then octet_length(encode(turns[d].t)) else 0 end as bytes
  from (select *, unnest(range(len(turns) + 1)) as d from rebuilt)),
nodes as (
  select d, k, any_value(pk) as pk, min(conv_id) as conv_id, count(*) as n_convs, (count(*) - 1) * any_value(bytes) as saved,
         max(length) = d as childless,
         sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where length = d), '')) as ends_sha256
  from prefixes group by d, k),
below as (
  select p.d, p.k, count(*) filter (where n.childless) as n_leaves, sum(n.saved) as saved
  from nodes n join prefixes p on p.conv_id = n.conv_id and p.d <= n.d group by p.d, p.k),
children as (select d - 1 as d, pk as k, count(*) as n from nodes where d > 0 group by 1, 2)
select n.conv_id, n.d::bigint as depth, u.conv_id as parent_conv_id, n.n_convs, coalesce(c.n, 0)::bigint as n_children,
       b.n_leaves::bigint as n_leaves, b.saved::bigint as saved_tokens, n.ends_sha256
from nodes n join below b on b.d = n.d and b.k = n.k left join children c on c.d = n.d and c.k = n.k
left join nodes u on u.d = n.d - 1 and u.k = n.pk
"""


@register("op13_conversation_prefix_trie", _SQL)
def op13_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations"))
