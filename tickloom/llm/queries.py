"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from . import decontaminate, language_id, line_dedup, packing, quality, simhash, telephony, token_count, url_filter, warc

QUERIES = {
    "op1_warc": warc.op1_warc,
    "op2_telephony": telephony.op2_telephony,
    "op3_url_filter": url_filter.op3_url_filter,
    "op4_language_id": language_id.op4_language_id,
    "op5_token_count": token_count.op5_token_count,
    "op6_line_dedup": line_dedup.op6_line_dedup,
    "op7_simhash": simhash.op7_simhash,
    "op8_packing": packing.op8_packing,
    "op9_quality": quality.op9_quality,
    "op10_decontamination": decontaminate.op10_decontamination,
}
SQL = {
    "op1_warc": warc.OP1_SQL,
    "op3_url_filter": url_filter.OP3_SQL,
    "op6_line_dedup": line_dedup.OP6_SQL,
    "op10_decontamination": decontaminate.OP10_SQL,
}
