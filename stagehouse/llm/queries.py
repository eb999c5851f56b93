"""Queries of the corpus operators and the SQL of those that SQL can express."""

from __future__ import annotations

from stagehouse.llm import chat, ctw, decontam, embed, jaccard, langid, license, mixing, negatives, quality, suffix, warc, whiten

QUERIES = {
    "op1_language_id": langid.op1_language_id,
    "op2_decontaminate": decontam.op2_decontaminate,
    "op3_suffix_dedup": suffix.op3_suffix_dedup,
    "op4_lm_score": ctw.op4_lm_score,
    "op5_source_mix": mixing.op5_source_mix,
    "op6_ngram_jaccard": jaccard.op6_ngram_jaccard,
    "op7_warc": warc.op7_warc,
    "op8_embedding_neardup": embed.op8_embedding_neardup,
    "op9_quality": quality.op9_quality,
    "op10_chat_format": chat.op10_chat_format,
    "op11_license_scan": license.op11_license_scan,
    "op12_hard_negatives": negatives.op12_hard_negatives,
    "op13_embedding_whitening": whiten.op13_embedding_whitening,
}

ORACLE_SQL = {
    "op5_source_mix": mixing.ORACLE_SQL,
    "op10_chat_format": chat.ORACLE_SQL,
    "op11_license_scan": license.ORACLE_SQL,
    "op12_hard_negatives": negatives.ORACLE_SQL,
}
