"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from . import bpe, decontaminate, language_id, media, quality, sharding, simhash, suffix_dedup, tokenfile, toxicity


def queries() -> dict:
    return {
        "op1_quality": quality.op1_quality,
        "op2_decontaminate": decontaminate.op2_decontaminate,
        "op3_language_id": language_id.op3_language_id,
        "op4_sharding": sharding.op4_sharding,
        "op5_toxicity": toxicity.op5_toxicity,
        "op6_token_files": tokenfile.op6_token_files,
        "op7_media": media.op7_media,
        "op8_suffix_dedup": suffix_dedup.op8_suffix_dedup,
        "op9_simhash": simhash.op9_simhash,
        "op10_bpe": bpe.op10_bpe,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_decontaminate": decontaminate.ORACLE}
