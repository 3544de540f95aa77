"""Registered queries of the operators and their SQL twins."""

from __future__ import annotations

from vecindad.llm import (
    alignment,
    class_ngrams,
    decontamination,
    jaccard_join,
    licenses,
    outliers,
    packing,
    pages,
    prefix_trie,
    rule_ensemble,
    sql,
    substrings,
    toxicity,
    warc,
)

QUERIES = {
    "op1_outliers": outliers.op1_outliers,
    "op2_rule_ensemble": rule_ensemble.op2_rule_ensemble,
    "op3_class_ngrams": class_ngrams.op3_class_ngrams,
    "op4_page_text": pages.op4_page_text,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_repeated_passages": substrings.op6_repeated_passages,
    "op7_decontamination": decontamination.op7_decontamination,
    "op8_licenses": licenses.op8_licenses,
    "op9_jaccard_components": jaccard_join.op9_jaccard_components,
    "op10_packing": packing.op10_packing,
    "op11_alignment": alignment.op11_alignment,
    "op12_archives": warc.op12_archives,
    "op13_prefix_trie": prefix_trie.op13_prefix_trie,
}

#: The others are fitted models, packings or page texts, which SQL cannot express.
ORACLE = {
    "op6_repeated_passages": sql.REPEATED,
    "op7_decontamination": sql.DECONTAMINATION,
    "op9_jaccard_components": sql.COMPONENTS,
    "op12_archives": sql.ARCHIVES,
    "op13_prefix_trie": sql.TRIE,
}
