"""Queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from patchlens.llm import conversation_tries, hard_negatives, secret_links, substring_dedup, template_leaks
from patchlens.llm.chat_windows import op4_chat_windows
from patchlens.llm.conversation_tries import op13_conversation_trie
from patchlens.llm.embedding_links import op9_hnsw_embeddings
from patchlens.llm.hard_negatives import op12_hard_negatives
from patchlens.llm.language_id import op10_language_id
from patchlens.llm.language_model import op6_gru_scores
from patchlens.llm.packing import op2_nnls_packing
from patchlens.llm.secret_links import op3_secret_links
from patchlens.llm.simhash_golay import op7_simhash_golay
from patchlens.llm.substring_dedup import op11_substring_dedup
from patchlens.llm.template_leaks import op8_template_leaks
from patchlens.llm.token_counts import op5_token_counts
from patchlens.llm.token_planes import op1_token_planes

QUERIES = {f.__name__: f for f in (op1_token_planes, op2_nnls_packing, op3_secret_links, op4_chat_windows,
                                   op5_token_counts, op6_gru_scores, op7_simhash_golay, op8_template_leaks,
                                   op9_hnsw_embeddings, op10_language_id, op11_substring_dedup,
                                   op12_hard_negatives, op13_conversation_trie)}
ORACLES: dict[str, str] = {"op3_secret_links": secret_links.SQL, "op8_template_leaks": template_leaks.SQL,
                           "op11_substring_dedup": substring_dedup.SQL,
                           "op12_hard_negatives": hard_negatives.SQL, "op13_conversation_trie": conversation_tries.SQL}
