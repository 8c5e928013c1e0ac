"""The queries of this subpackage and, where SQL can say the same, their SQL."""

from __future__ import annotations

from . import decontaminate, embeddings, filters, language, mixing, neardup, pii, quality, ranking, secrets, substrings, toxicity, warc


def queries() -> dict:
    return {
        "op1_embeddings": embeddings.op1_embeddings,
        "op2_mix": mixing.op2_mix,
        "op3_language": language.op3_language,
        "op4_substrings": substrings.op4_substrings,
        "op5_decontaminate": decontaminate.op5_decontaminate,
        "op6_pii": pii.op6_pii,
        "op7_neardup": neardup.op7_neardup,
        "op8_secrets": secrets.op8_secrets,
        "op9_warc": warc.op9_warc,
        "op10_toxicity": toxicity.op10_toxicity,
        "op11_filters": filters.op11_filters,
        "op12_ranking": ranking.op12_ranking,
        "op13_quality": quality.op13_quality,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_embeddings": embeddings.OP1_SQL, "op2_mix": mixing.OP2_SQL, "op4_substrings": substrings.OP4_SQL, "op7_neardup": neardup.OP7_SQL, "op9_warc": warc.OP9_SQL, "op11_filters": filters.OP11_SQL, "op12_ranking": ranking.OP12_SQL}
