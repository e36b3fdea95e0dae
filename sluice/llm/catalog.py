"""The queries of this package and, where SQL can express them, their DuckDB SQL."""
from __future__ import annotations

from . import alignment, chat, fingerprint, html, jaccard, licenses, lines, packing, pieces, pii, quality, secrets, spelling

QUERIES = {
    "op1_ngram_jaccard": jaccard.op1_ngram_jaccard,
    "op2_quality_rules": quality.op2_quality_rules,
    "op3_html_extraction": html.op3_html_extraction,
    "op4_personal_data": pii.op4_personal_data,
    "op5_piece_dropout": pieces.op5_piece_dropout,
    "op6_document_fingerprints": fingerprint.op6_document_fingerprints,
    "op7_chat_formatting": chat.op7_chat_formatting,
    "op8_line_dedup": lines.op8_line_dedup,
    "op9_secret_scans": secrets.op9_secret_scans,
    "op10_best_fit_packing": packing.op10_best_fit_packing,
    "op11_license_scans": licenses.op11_license_scans,
    "op12_token_alignment": alignment.op12_token_alignment,
    "op13_spelling_variants": spelling.op13_spelling_variants,
}

SQL = {
    "op1_ngram_jaccard": jaccard.SQL,
    "op2_quality_rules": quality.SQL,
    "op7_chat_formatting": chat.SQL,
    "op8_line_dedup": lines.SQL,
    "op9_secret_scans": secrets.SQL,
}
