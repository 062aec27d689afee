"""Queries of this package, and DuckDB statements where SQL can express them."""

from __future__ import annotations

from sliceflow.llm import chat, divergence, itq_dedup, url_graph
from sliceflow.llm.alignment import op12_tokenizer_alignment
from sliceflow.llm.language_id import op11_language_id
from sliceflow.llm.mixing import op5_mixing
from sliceflow.llm.packing import op2_best_fit_packing
from sliceflow.llm.permutation_index import op3_permutation_index
from sliceflow.llm.shingle_join import op9_ngram_jaccard_join
from sliceflow.llm.token_files import op1_token_files
from sliceflow.llm.toxicity import op8_toxicity
from sliceflow.llm.warc import op10_warc_zstd

QUERIES = {f.__name__: f for f in (
    op1_token_files, op2_best_fit_packing, op3_permutation_index, url_graph.op4_url_graph, op5_mixing, itq_dedup.op6_itq_dedup,
    chat.op7_chat_formatting, op8_toxicity, op9_ngram_jaccard_join, op10_warc_zstd,
    op11_language_id, op12_tokenizer_alignment, divergence.op13_source_divergence)}

ORACLE = {"op4_url_graph": url_graph.ORACLE, "op6_itq_dedup": itq_dedup.ORACLE, "op7_chat_formatting": chat.ORACLE,
          "op13_source_divergence": divergence.ORACLE}
