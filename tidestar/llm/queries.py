"""The registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tidestar.llm import chat_format, decontaminate, line_dedup, mixing, periodic_runs, spelling
from tidestar.llm.chat_format import op9_reply_trees
from tidestar.llm.context_tree import op12_context_tree
from tidestar.llm.decontaminate import op4_positional_index
from tidestar.llm.language_id import op7_byte_network
from tidestar.llm.line_dedup import op2_site_spread
from tidestar.llm.mixing import op1_pareto_mix
from tidestar.llm.near_dedup import op10_chosen_path
from tidestar.llm.periodic_runs import op11_multi_scale_minimizers
from tidestar.llm.privacy import op5_disclosure
from tidestar.llm.quality_gam import op6_pairwise_gam
from tidestar.llm.quality_rules import op3_line_crf
from tidestar.llm.spelling import op13_group_trie
from tidestar.llm.token_counts import op8_longest_match

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pareto_mix": op1_pareto_mix,
    "op2_site_spread": op2_site_spread,
    "op3_line_crf": op3_line_crf,
    "op4_positional_index": op4_positional_index,
    "op5_disclosure": op5_disclosure,
    "op6_pairwise_gam": op6_pairwise_gam,
    "op7_byte_network": op7_byte_network,
    "op8_longest_match": op8_longest_match,
    "op9_reply_trees": op9_reply_trees,
    "op10_chosen_path": op10_chosen_path,
    "op11_multi_scale_minimizers": op11_multi_scale_minimizers,
    "op12_context_tree": op12_context_tree,
    "op13_group_trie": op13_group_trie,
    "pipeline": corpus_pipeline.run,
}

SQL: dict[str, str] = {
    "op1_pareto_mix": mixing.OP1_SQL,
    "op2_site_spread": line_dedup.OP2_SQL,
    "op4_positional_index": decontaminate.OP4_SQL,
    "op9_reply_trees": chat_format.OP9_SQL,
    "op11_multi_scale_minimizers": periodic_runs.OP11_SQL,
    "op13_group_trie": spelling.OP13_SQL,
}

if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
