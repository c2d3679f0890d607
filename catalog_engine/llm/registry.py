"""Queries over whole tables, one for each operator, and the SQL they are compared with."""

from __future__ import annotations

from catalog_engine.llm import (
    bpe, collocations, divergence, factorization, language, licenses, mixing, neighbours, recompress, sharding, simhash, source_audit, toxicity,
)

QUERIES = {
    f.__name__: f
    for f in (
        divergence.op1_quality_divergence,
        licenses.op2_license_scan,
        language.op3_language_id,
        simhash.op4_simhash_near_dedup,
        bpe.op5_bpe_encode_decode,
        toxicity.op6_toxicity,
        mixing.op7_mix_sources,
        neighbours.op8_nearest_neighbours,
        sharding.op9_reshard,
        recompress.op10_substring_dedup,
        factorization.op11_factorization_quality,
        source_audit.op12_source_audit,
        collocations.op13_collocations,
    )
}
COMPARISONS = {
    "op2_license_scan": licenses.scan_sql(), "op7_mix_sources": mixing.MIX_SQL, "op12_source_audit": source_audit.AUDIT_SQL,
    "op13_collocations": collocations.COLLOCATIONS_SQL,
}
