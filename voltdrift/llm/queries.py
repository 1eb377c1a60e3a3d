"""The operators' queries, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from voltdrift.llm.conversation_repair import op11_conversation_repair
from voltdrift.llm.conversation_trie import op13_conversation_trie
from voltdrift.llm.decontaminate import op5_decontamination
from voltdrift.llm.line_dedup import op1_line_dedup
from voltdrift.llm.license_scan import op12_license_scan
from voltdrift.llm.line_quality import op3_quality
from voltdrift.llm.packing import op9_packing
from voltdrift.llm.oracles import ORACLES
from voltdrift.llm.page_text import op4_html_extraction
from voltdrift.llm.personal_data import op8_personal_data
from voltdrift.llm.simhash_dedup import op2_simhash_neardup
from voltdrift.llm.toxicity import op10_toxicity
from voltdrift.llm.vector_search import op7_mtree_topk
from voltdrift.llm.word_language import op6_language

__all__ = ["ORACLES", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_simhash_neardup": op2_simhash_neardup,
    "op3_quality": op3_quality,
    "op4_html_extraction": op4_html_extraction,
    "op5_decontamination": op5_decontamination,
    "op6_language": op6_language,
    "op7_mtree_topk": op7_mtree_topk,
    "op8_personal_data": op8_personal_data,
    "op9_packing": op9_packing,
    "op10_toxicity": op10_toxicity,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_license_scan": op12_license_scan,
    "op13_conversation_trie": op13_conversation_trie,
}
