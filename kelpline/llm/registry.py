"""Registered corpus queries and the SQL they are compared with, where SQL can express them."""

from __future__ import annotations

from . import compaction, decontam, html_text, lm_score, ordinal, outliers, packing, pii, simhash, warc

QUERIES: dict = {
    "op1_simhash": simhash.query,
    "op2_packing": packing.query,
    "op3_pii": pii.query,
    "op4_html": html_text.query,
    "op5_compaction": compaction.query,
    "op6_warc": warc.query,
    "op7_lm_score": lm_score.query,
    "op8_decontam": decontam.query,
    "op9_outliers": outliers.query,
    "op10_ordinal": ordinal.query,
}
ORACLES: dict[str, str] = {
    "op2_packing": packing.ORACLE,
    "op3_pii": pii.ORACLE,
    "op6_warc": warc.ORACLE,
    "op7_lm_score": lm_score.ORACLE,
}
