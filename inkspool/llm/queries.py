"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from inkspool.llm import chat, decontaminate, language, licenses, lm, mixing, neardup, quality, secrets, tokens

QUERIES = {
    "op1_quality": quality.op1_quality,
    "op2_licenses": licenses.op2_licenses,
    "op3_language": language.op3_language,
    "op4_lm": lm.op4_lm,
    "op5_chat": chat.op5_chat,
    "op6_neardup": neardup.op6_neardup,
    "op7_mixing": mixing.op7_mixing,
    "op8_secrets": secrets.op8_secrets,
    "op9_decontaminate": decontaminate.op9_decontaminate,
    "op10_tokens": tokens.op10_tokens,
}

#: Only where SQL can express the whole result.
SQL = {
    "op1_quality": quality.OP1_SQL,
    "op7_mixing": mixing.mixing_sql(),
}
