"""Query op11: all documents for fill-in-middle training, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from strata.llm.fim import restore, transform
from strata.llm.registry import register, table

_SQL = r"""
with drawn as (
  select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as units,
         sha256('1:' || coalesce(doc_id::varchar, '')) as h
  from documents),
numbers as (
  select *, len(units) as n, ('0x' || substr(h, 1, 8))::bigint as h1, ('0x' || substr(h, 9, 8))::bigint as h2,
         ('0x' || substr(h, 17, 8))::bigint as h3, ('0x' || substr(h, 25, 8))::bigint as h4
  from drawn),
cut as (
  select doc_id, text, n, array_to_string(units[1:least(h1 % (n + 1), h2 % (n + 1))], '') as prefix,
         array_to_string(units[least(h1 % (n + 1), h2 % (n + 1)) + 1:greatest(h1 % (n + 1), h2 % (n + 1))], '') as middle,
         array_to_string(units[greatest(h1 % (n + 1), h2 % (n + 1)) + 1:n], '') as suffix,
         case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 90
              then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form
  from numbers)
select doc_id, n, form, case when form <> 'plain' then length(prefix) end as prefix_chars,
       case when form <> 'plain' then length(middle) end as middle_chars,
       sha256(case form when 'plain' then text
                        when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
       sha256(text) as restored_sha256
from cut
"""


def _digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


@register("op11_fill_in_middle", _SQL)
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = restore(transform(docs).drop("text"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", _digest(F.col("output")).alias("output_sha256"),
                      _digest(F.col("restored")).alias("restored_sha256"))
