"""The registered corpus queries and their SQL answers."""

from __future__ import annotations

from tracklake.llm import decontamination, embeddings, html_text, language, licenses, minhash, mixing, pieces, pivots, substrings, token_alignment, url_filter, warc

QUERIES = {
    "op1_url_filter": url_filter.op1_url_filter,
    "op2_warc": warc.op2_warc,
    "op3_substrings": substrings.op3_substrings,
    "op4_decontamination": decontamination.op4_decontamination,
    "op5_embeddings": embeddings.op5_embeddings,
    "op6_language": language.op6_language,
    "op7_mixing": mixing.op7_mixing,
    "op8_html_text": html_text.op8_html_text,
    "op9_minhash": minhash.op9_minhash,
    "op10_licenses": licenses.op10_licenses,
    "op11_pieces": pieces.op11_pieces,
    "op12_pivots": pivots.op12_pivots,
    "op13_token_alignment": token_alignment.op13_token_alignment,
}
ORACLES = {
    "op1_url_filter": url_filter.ORACLE,
    "op2_warc": warc.ORACLE,
    "op3_substrings": substrings.ORACLE,
    "op5_embeddings": embeddings.ORACLE,
    "op7_mixing": mixing.ORACLE,
    "op9_minhash": minhash.ORACLE,
    "op12_pivots": pivots.ORACLE,
}
