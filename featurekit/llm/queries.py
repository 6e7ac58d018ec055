"""The registered queries of this subpackage, and their SQL."""

from __future__ import annotations

import corpus_pipeline
from featurekit.llm.align import op12_token_alignment
from featurekit.llm.chat import op8_chat_format
from featurekit.llm.decontaminate import op9_decontaminate
from featurekit.llm.html import op6_html_extract
from featurekit.llm.jaccard import op2_jaccard_join
from featurekit.llm.language import op10_language_id
from featurekit.llm.mixing import op5_mix_sources
from featurekit.llm.oracle import ORACLE
from featurekit.llm.pii import op4_pii
from featurekit.llm.quality import op3_quality_rules
from featurekit.llm.secrets import op1_secret_scan
from featurekit.llm.toxicity import op11_toxicity
from featurekit.llm.trie import op13_prefix_trie
from featurekit.llm.warc import op7_warc

QUERIES = {f.__name__: f for f in (
    op1_secret_scan, op2_jaccard_join, op3_quality_rules, op4_pii, op5_mix_sources, op6_html_extract, op7_warc, op8_chat_format,
    op9_decontaminate, op10_language_id, op11_toxicity, op12_token_alignment, op13_prefix_trie)} | {"pipeline": corpus_pipeline.run}

ORACLES = ORACLE | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
