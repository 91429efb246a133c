"""Registered queries of this folder, one for each operator, and their SQL."""

from __future__ import annotations

from litmill.llm.chat import OP9_SQL, op9_chat_format
from litmill.llm.decontaminate import OP3_SQL, op3_decontaminate
from litmill.llm.infill import OP12_SQL, op12_fill_in_middle
from litmill.llm.line_dedup import OP10_SQL, op10_line_dedup
from litmill.llm.url_filter import OP2_SQL, op2_url_filter
from litmill.llm.vector_search import OP5_SQL, op5_exact_topk
from litmill.llm.warc import OP1_SQL, op1_warc
from litmill.llm.near_duplicates import OP8_SQL, op8_ngram_join
from litmill.llm.packing import op4_best_fit_packing
from litmill.llm.pieces import op13_sentencepiece
from litmill.llm.quality import op6_quality
from litmill.llm.resampling import OP11_SQL, op11_importance_resampling
from litmill.llm.toxicity import op7_toxicity

QUERIES = {
    "op1_warc": op1_warc,
    "op2_url_filter": op2_url_filter,
    "op3_decontaminate": op3_decontaminate,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_exact_topk": op5_exact_topk,
    "op6_quality": op6_quality,
    "op7_toxicity": op7_toxicity,
    "op8_ngram_join": op8_ngram_join,
    "op9_chat_format": op9_chat_format,
    "op10_line_dedup": op10_line_dedup,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_sentencepiece": op13_sentencepiece,
}

ORACLE_SQL = {
    "op1_warc": OP1_SQL,
    "op2_url_filter": OP2_SQL,
    "op3_decontaminate": OP3_SQL,
    "op5_exact_topk": OP5_SQL,
    "op8_ngram_join": OP8_SQL,
    "op9_chat_format": OP9_SQL,
    "op10_line_dedup": OP10_SQL,
    "op11_importance_resampling": OP11_SQL,
    "op12_fill_in_middle": OP12_SQL,
}
