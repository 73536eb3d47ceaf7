"""Queries of the training-data operators and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from kpistar.llm import chat, divergence, minhash_dedup, packing, vector_codes, vectors
from kpistar.llm.decontaminate import op3_decontaminate
from kpistar.llm.language import op9_language
from kpistar.llm.pieces import op8_pieces
from kpistar.llm.quality import op6_quality
from kpistar.llm.secret_scan import op5_secrets
from kpistar.llm.substrings import op2_substrings
from kpistar.llm.tokencount import op7_token_counts

QUERIES = {
    "op1_vectors": vectors.op1_vectors,
    "op2_substrings": op2_substrings,
    "op3_decontaminate": op3_decontaminate,
    "op4_chat": chat.op4_chat,
    "op5_secrets": op5_secrets,
    "op6_quality": op6_quality,
    "op7_token_counts": op7_token_counts,
    "op8_pieces": op8_pieces,
    "op9_language": op9_language,
    "op10_minhash_dedup": minhash_dedup.op10_minhash_dedup,
    "op11_packing": packing.op11_packing,
    "op12_vector_codes": vector_codes.op12_vector_codes,
    "op13_source_divergence": divergence.op13_source_divergence,
}

ORACLE: dict[str, str] = {
    "op1_vectors": vectors.ORACLE_SQL,
    "op4_chat": chat.ORACLE_SQL,
    "op10_minhash_dedup": minhash_dedup.ORACLE_SQL,
    "op12_vector_codes": vector_codes.ORACLE_SQL,
    "op13_source_divergence": divergence.ORACLE_SQL,
}
