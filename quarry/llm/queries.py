"""Registered queries of this subpackage and their SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from quarry.llm.annsearch import op4_ann_search
from quarry.llm.chat import OP5_SQL, op5_chat_format
from quarry.llm.fim import OP12_SQL, op12_fim
from quarry.llm.licenses import op6_license_scan
from quarry.llm.minhash import op3_minhash_dedup
from quarry.llm.mixing import OP7_SQL, op7_mixing
from quarry.llm.packing import op8_packing
from quarry.llm.pii import op10_pii
from quarry.llm.quality import OP11_SQL, op11_quality_rules
from quarry.llm.rpforest import op1_embedding_dedup
from quarry.llm.suffixtree import op9_suffix_tree
from quarry.llm.toxicity import op2_toxicity
from quarry.llm.trie import OP13_SQL, op13_prefix_trie

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_minhash_dedup": op3_minhash_dedup,
    "op4_ann_search": op4_ann_search,
    "op5_chat_format": op5_chat_format,
    "op6_license_scan": op6_license_scan,
    "op7_mixing": op7_mixing,
    "op8_packing": op8_packing,
    "op9_suffix_tree": op9_suffix_tree,
    "op10_pii": op10_pii,
    "op11_quality_rules": op11_quality_rules,
    "op12_fim": op12_fim,
    "op13_prefix_trie": op13_prefix_trie,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL: dict[str, str] = {"op5_chat_format": OP5_SQL, "op7_mixing": OP7_SQL, "op11_quality_rules": OP11_SQL,
                              "op12_fim": OP12_SQL, "op13_prefix_trie": OP13_SQL}
if corpus_pipeline.ORACLE_SQL:
    ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
