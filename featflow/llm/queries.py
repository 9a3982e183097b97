"""Registry of this subpackage: ``QUERIES`` (Spark) and ``ORACLE_SQL`` (DuckDB,
where SQL can express the query)."""

from __future__ import annotations

from featflow.llm import (byte_bpe, chat, decontam, fill_middle, hard_negatives, lang_id, packing,
                          quality, secret_scan, simhash, suffix_dedup, token_count, token_files)

QUERIES = {
    "op1_lang_id": lang_id.op1_lang_id,
    "op2_byte_bpe": byte_bpe.op2_byte_bpe,
    "op3_secrets": secret_scan.op3_secrets,
    "op4_decontam": decontam.op4_decontam,
    "op5_simhash": simhash.op5_simhash,
    "op6_chat": chat.op6_chat,
    "op7_quality": quality.op7_quality,
    "op8_repeats": suffix_dedup.op8_repeats,
    "op9_token_count": token_count.op9_token_count,
    "op10_token_files": token_files.op10_token_files,
    "op11_fill_middle": fill_middle.op11_fill_middle,
    "op12_hard_negatives": hard_negatives.op12_hard_negatives,
    "op13_packing": packing.op13_packing,
}

ORACLE_SQL = {
    "op4_decontam": decontam.SQL_OP4,
    "op6_chat": chat.SQL_OP6,
    "op7_quality": quality.SQL_OP7,
    "op8_repeats": suffix_dedup.SQL_OP8,
    "op11_fill_middle": fill_middle.SQL_OP11,
    "op12_hard_negatives": hard_negatives.SQL_OP12,
}
