"""The registered queries of this package: name -> (function, DuckDB oracle or None)."""

from __future__ import annotations

from capture_lake.llm import bitslice, chat, collocations, hard_negatives
from capture_lake.llm.bitslice import op3_bitsliced_topk
from capture_lake.llm.chat import op7_chat_formatting
from capture_lake.llm.collocations import op12_collocations
from capture_lake.llm.hard_negatives import op13_hard_negatives
from capture_lake.llm.html_extract import op11_html_extraction
from capture_lake.llm.langid import op10_language_id
from capture_lake.llm.minhash import op9_document_fingerprints
from capture_lake.llm.quality import op5_quality_classifier
from capture_lake.llm.simhash import op4_simhash_near_dedup
from capture_lake.llm.surrogates import op2_pii_surrogates
from capture_lake.llm.swap_packing import op1_best_fit_packing
from capture_lake.llm.token_output import op6_token_output
from capture_lake.llm.unigram import op8_unigram_segmentation

REGISTRY: dict = {
    "op1_best_fit_packing": (op1_best_fit_packing, None),
    "op2_pii_surrogates": (op2_pii_surrogates, None),
    "op3_bitsliced_topk": (op3_bitsliced_topk, bitslice.ORACLE),
    "op4_simhash_near_dedup": (op4_simhash_near_dedup, None),
    "op5_quality_classifier": (op5_quality_classifier, None),
    "op6_token_output": (op6_token_output, None),
    "op7_chat_formatting": (op7_chat_formatting, chat.ORACLE),
    "op8_unigram_segmentation": (op8_unigram_segmentation, None),
    "op9_document_fingerprints": (op9_document_fingerprints, None),
    "op10_language_id": (op10_language_id, None),
    "op11_html_extraction": (op11_html_extraction, None),
    "op12_collocations": (op12_collocations, collocations.ORACLE),
    "op13_hard_negatives": (op13_hard_negatives, hard_negatives.ORACLE),
}
