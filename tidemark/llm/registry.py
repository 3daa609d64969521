"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from tidemark.llm import op1_quality_rules as op1
from tidemark.llm import op2_chat_format as op2
from tidemark.llm import op3_token_counts as op3
from tidemark.llm import op4_simhash as op4
from tidemark.llm import op5_sentencepiece as op5
from tidemark.llm import op6_quality_classifier as op6
from tidemark.llm import op7_decontamination as op7
from tidemark.llm import op8_language_id as op8
from tidemark.llm import op9_suffix_array as op9
from tidemark.llm import op10_toxicity as op10


def queries():
    return {
        "op1_quality_rules": op1.op1_quality_rules,
        "op2_chat_format": op2.op2_chat_format,
        "op3_token_counts": op3.op3_token_counts,
        "op4_simhash": op4.op4_simhash,
        "op5_sentencepiece": op5.op5_sentencepiece,
        "op6_quality_classifier": op6.op6_quality_classifier,
        "op7_decontamination": op7.op7_decontamination,
        "op8_language_id": op8.op8_language_id,
        "op9_suffix_array": op9.op9_suffix_array,
        "op10_toxicity": op10.op10_toxicity,
    }


def oracle_sql():
    return {"op1_quality_rules": op1.ORACLE_SQL, "op2_chat_format": op2.ORACLE_SQL, "op7_decontamination": op7.ORACLE_SQL, "op9_suffix_array": op9.ORACLE_SQL}
