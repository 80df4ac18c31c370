"""The queries of this subpackage, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from strandline.llm import decontaminate, divergence, language_id, line_rules, manifest, minhash, mixing, quality, secrets, simhash, suffix_dedup, toxicity, warc


def queries() -> dict:
    return {
        "op1_suffix_dedup": suffix_dedup.op1_suffix_dedup,
        "op2_quality": quality.op2_quality,
        "op3_secrets": secrets.op3_secrets,
        "op4_decontaminate": decontaminate.op4_decontaminate,
        "op5_warc": warc.op5_warc,
        "op6_language_id": language_id.op6_language_id,
        "op7_line_rules": line_rules.op7_line_rules,
        "op8_mixing": mixing.op8_mixing,
        "op9_toxicity": toxicity.op9_toxicity,
        "op10_simhash": simhash.op10_simhash,
        "op11_minhash": minhash.op11_minhash,
        "op12_manifest": manifest.op12_manifest,
        "op13_divergence": divergence.op13_divergence,
    }


def oracle_sql() -> dict:
    return {"op1_suffix_dedup": suffix_dedup.OP1_SQL, "op5_warc": warc.OP5_SQL, "op7_line_rules": line_rules.OP7_SQL, "op8_mixing": mixing.OP8_SQL, "op11_minhash": minhash.OP11_SQL, "op12_manifest": manifest.OP12_SQL, "op13_divergence": divergence.OP13_SQL}
