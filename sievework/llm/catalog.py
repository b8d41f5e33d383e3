"""The queries of this package by name, and SQL for those that SQL can express."""

from __future__ import annotations

from sievework.llm.chat import OP3_SQL, op3_budgeted_windows
from sievework.llm.media import op4_signature_sniffing
from sievework.llm.packing import op1_pattern_packing
from sievework.llm.pieces import op10_sentencepiece
from sievework.llm.sharding import op2_hilbert_sharding
from sievework.llm.simhash import op9_simhash_components
from sievework.llm.suffix import op8_suffix_dedup
from sievework.llm.toxicity import op5_crf_toxicity
from sievework.llm.warc import op7_content_addressed_warc
from sievework.llm.weighted import op6_weighted_sampling

QUERIES = {f.__name__: f for f in (op1_pattern_packing, op2_hilbert_sharding, op3_budgeted_windows, op4_signature_sniffing, op5_crf_toxicity, op6_weighted_sampling, op7_content_addressed_warc, op8_suffix_dedup, op9_simhash_components, op10_sentencepiece)}

ORACLE_SQL: dict[str, str] = {"op3_budgeted_windows": OP3_SQL}
