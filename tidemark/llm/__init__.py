"""Operators for training-data pipelines. Nothing else in the package imports this folder.

queries() maps opN_<name> to its query over the tables of a folder, oracle_sql() those that DuckDB can state.
"""

from __future__ import annotations

from . import chat, decontam, licences, line_dedup, main_text, mixing, quality_model, quality_rules, set_join, token_tables

QUERIES = {
    f.__name__: f
    for f in (
        mixing.op1_mix_sources,
        main_text.op2_main_text,
        quality_model.op3_quality_model,
        quality_rules.op4_quality_rules,
        chat.op5_preference_pairs,
        line_dedup.op6_line_dedup,
        token_tables.op7_token_tables,
        licences.op8_licence_scan,
        decontam.op9_decontaminate,
        set_join.op10_jaccard_join,
    )
}
SQL = {
    "op1_mix_sources": mixing.OP1_SQL,
    "op5_preference_pairs": chat.OP5_SQL,
    "op8_licence_scan": licences.OP8_SQL,
    "op9_decontaminate": decontam.OP9_SQL,
}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
