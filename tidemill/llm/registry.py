"""Queries of the operators, and their SQL where it can express them."""

from __future__ import annotations

from . import language, lm, mixing, neighbours, packing, pii, secrets, simhash, topk, warc

QUERIES = {
    "op1_pii": pii.op1_pii,
    "op2_threshold_topk": topk.op2_threshold_topk,
    "op3_projected_neighbours": neighbours.op3_projected_neighbours,
    "op4_mixing": mixing.op4_mixing,
    "op5_pitman_yor": lm.op5_pitman_yor,
    "op6_simhash": simhash.op6_simhash,
    "op7_warc": warc.op7_warc,
    "op8_language": language.op8_language,
    "op10_packing": packing.op10_packing,
    "op9_secret_scan": secrets.op9_secret_scan,
}

ORACLES: dict[str, str] = {
    "op2_threshold_topk": topk.OP2_SQL,
    "op4_mixing": mixing.OP4_SQL,
    "op7_warc": warc.sql(),
}
