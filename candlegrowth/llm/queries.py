"""The registered queries of the training-data operators, and their SQL where SQL can express them."""

from candlegrowth.llm import (
    decontaminate, divergence, imatch, katz, langid, licenses, lines, middle, mixing, pieces, pseudonyms,
    simhash, substrings,
)

QUERIES = {
    "op1_language_id": langid.op1_language_id,
    "op2_line_dedup": lines.op2_line_dedup,
    "op3_decontamination": decontaminate.op3_decontamination,
    "op4_pseudonyms": pseudonyms.op4_pseudonyms,
    "op5_mixing": mixing.op5_mixing,
    "op6_simhash": simhash.op6_simhash,
    "op7_license_scan": licenses.op7_license_scan,
    "op8_substring_dedup": substrings.op8_substring_dedup,
    "op9_katz_lm": katz.op9_katz_lm,
    "op10_imatch": imatch.op10_imatch,
    "op11_sentencepiece": pieces.op11_sentencepiece,
    "op12_fill_in_middle": middle.op12_fill_in_middle,
    "op13_source_divergence": divergence.op13_source_divergence,
}
SQL = {
    "op8_substring_dedup": substrings.OP8_SQL,
    "op12_fill_in_middle": middle.OP12_SQL,
    "op13_source_divergence": divergence.OP13_SQL,
}
