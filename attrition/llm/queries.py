"""Registered queries and SQL of this folder."""

from __future__ import annotations

from attrition.llm.bpe_codec import op4_bpe_codec
from attrition.llm.conversation_trie import OP11_SQL, op11_conversation_trie
from attrition.llm.decontamination import OP9_SQL, op9_decontamination
from attrition.llm.embedding_dedup import OP6_SQL, op6_embedding_dedup
from attrition.llm.language_id import op8_language_id
from attrition.llm.license_scan import op7_license_scan
from attrition.llm.lm_scoring import op1_lm_scoring
from attrition.llm.minhash_dedup import OP3_SQL, op3_minhash_dedup
from attrition.llm.spot_signatures import op12_document_fingerprints
from attrition.llm.substring_dedup import OP2_SQL, op2_substring_dedup
from attrition.llm.token_files import op5_token_files
from attrition.llm.token_alignment import op13_token_alignment
from attrition.llm.toxicity import op10_toxicity

QUERIES = {f.__name__: f for f in (
    op1_lm_scoring, op2_substring_dedup, op3_minhash_dedup, op4_bpe_codec, op5_token_files, op6_embedding_dedup,
    op7_license_scan, op8_language_id, op9_decontamination, op10_toxicity, op11_conversation_trie,
    op12_document_fingerprints, op13_token_alignment)}
ORACLES: dict[str, str] = {"op2_substring_dedup": OP2_SQL, "op3_minhash_dedup": OP3_SQL, "op6_embedding_dedup": OP6_SQL, "op9_decontamination": OP9_SQL,
                           "op11_conversation_trie": OP11_SQL}
