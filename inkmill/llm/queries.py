"""Queries of the subpackage: ``opN_<name>`` over whole tables, and SQL where it can express them."""

from inkmill.llm import collocations, decontamination, fingerprints, html, language, lines, near, packing, quality, quantiles, scoring, simhash, substrings

QUERIES = {
    "op1_ngram_jaccard": near.op1,
    "op2_decontamination": decontamination.op2,
    "op3_fingerprints": fingerprints.op3,
    "op4_language_id": language.op4,
    "op5_line_dedup": lines.op5,
    "op6_substring_dedup": substrings.op6,
    "op7_quality_fm": quality.op7,
    "op8_html_extraction": html.op8,
    "op9_packing": packing.op9,
    "op10_lm_scoring": scoring.op10,
    "op11_collocations": collocations.op11,
    "op12_gk_quantiles": quantiles.op12,
    "op13_simhash_near_dedup": simhash.op13,
}

ORACLES = {
    "op1_ngram_jaccard": near.OP1_SQL,
    "op2_decontamination": decontamination.OP2_SQL,
    "op5_line_dedup": lines.OP5_SQL,
    "op10_lm_scoring": scoring.OP10_SQL,
    "op11_collocations": collocations.OP11_SQL,
}
