"""Registered queries of this subpackage and their DuckDB SQL (where SQL can express them)."""

from __future__ import annotations

from draftledger.llm import (
    audit, decontaminate, extract, fim, mixing, passages, pii, quality, secret_scan, shards, simhash, toxicity, warc)

QUERIES = {
    "op1_simhash": simhash.query,
    "op2_extract": extract.query,
    "op3_secrets": secret_scan.query,
    "op4_mixing": mixing.query,
    "op5_passages": passages.query,
    "op6_quality": quality.query,
    "op7_warc": warc.query,
    "op8_decontaminate": decontaminate.query,
    "op9_pii": pii.query,
    "op10_toxicity": toxicity.query,
    "op11_shards": shards.query,
    "op12_fim": fim.query,
    "op13_audit": audit.query,
}

ORACLE_SQL = {
    "op4_mixing": mixing.ORACLE,
    "op7_warc": warc.ORACLE,
    "op8_decontaminate": decontaminate.ORACLE,
    "op12_fim": fim.ORACLE,
    "op13_audit": audit.ORACLE,
}
