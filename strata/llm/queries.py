"""All queries of this subpackage: importing their modules registers them."""

from __future__ import annotations

from strata.llm import bpe_queries, chat_queries, decontaminate_queries, fim_queries, jaccard_queries, langid_queries, lm_queries, neardup_queries, quality_queries, rules_queries, tokencount_queries, toxicity_queries, trie_queries  # noqa: F401
from strata.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
