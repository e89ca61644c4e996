"""Queries of the corpus operators and the SQL they must agree with."""

from __future__ import annotations

from lendscape.llm import (
    collocations,
    fingerprints,
    licences,
    line_chunks,
    mixture,
    near_duplicates,
    packing,
    quality_rules,
    secret_scan,
    spelling,
    token_counts,
    url_filters,
    warc,
)

QUERIES = {
    "op1_near_duplicates": near_duplicates.op1_near_duplicates,
    "op2_mixture": mixture.op2_mixture,
    "op3_line_dedup": line_chunks.op3_line_dedup,
    "op4_secret_scan": secret_scan.op4_secret_scan,
    "op5_licences": licences.op5_licences,
    "op6_packing": packing.op6_packing,
    "op7_warc": warc.op7_warc,
    "op8_fingerprints": fingerprints.op8_fingerprints,
    "op9_token_counts": token_counts.op9_token_counts,
    "op10_quality_rules": quality_rules.op10_quality_rules,
    "op11_collocations": collocations.op11_collocations,
    "op12_spelling": spelling.op12_spelling,
    "op13_url_filters": url_filters.op13_url_filters,
}
ORACLE = {
    "op1_near_duplicates": near_duplicates.OP1_SQL,
    "op2_mixture": mixture.OP2_SQL,
    "op3_line_dedup": line_chunks.OP3_SQL,
    "op4_secret_scan": secret_scan.OP4_SQL,
    "op7_warc": warc.OP7_SQL,
    "op10_quality_rules": quality_rules.OP10_SQL,
}
