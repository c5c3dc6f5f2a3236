"""The registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from . import classifier, collocations, decontaminate, htmltext, licenses, mixing, pii, rules, simhash, substrings, tokens, urlfilter, whitening

QUERIES = {
    "op1_simhash": simhash.op1_simhash,
    "op2_urlfilter": urlfilter.op2_urlfilter,
    "op3_html": htmltext.op3_html,
    "op4_classifier": classifier.op4_classifier,
    "op5_decontaminate": decontaminate.op5_decontaminate,
    "op6_mixing": mixing.op6_mixing,
    "op7_tokens": tokens.op7_tokens,
    "op8_substrings": substrings.op8_substrings,
    "op9_rules": rules.op9_rules,
    "op10_pii": pii.op10_pii,
    "op11_collocations": collocations.op11_collocations,
    "op12_whitening": whitening.op12_whitening,
    "op13_licenses": licenses.op13_licenses,
}
ORACLE = {
    "op2_urlfilter": urlfilter.ORACLE,
    "op3_html": htmltext.ORACLE,
    "op5_decontaminate": decontaminate.ORACLE,
    "op8_substrings": substrings.ORACLE,
    "op11_collocations": collocations.ORACLE,
    "op13_licenses": licenses.ORACLE,
}
