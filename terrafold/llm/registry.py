"""Queries of this subpackage, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from terrafold.llm import cross_polytope, decontaminate, html_density, langid, licenses, mixing, near_join, periodic_runs, sharding, spelling, substring_dedup, suffix_dedup, toxicity

QUERIES = {
    "op1_license_scan": licenses.query,
    "op2_cross_polytope": cross_polytope.query,
    "op3_decontaminate": decontaminate.query,
    "op4_substring_dedup": substring_dedup.query,
    "op5_shard": sharding.query,
    "op6_mix": mixing.query,
    "op7_html_density": html_density.query,
    "op8_toxicity": toxicity.query,
    "op9_ngram_join": near_join.query,
    "op10_language_id": langid.query,
    "op11_periodic_runs": periodic_runs.query,
    "op12_spelling": spelling.query,
    "op13_suffix_dedup": suffix_dedup.query,
}

ORACLES = {
    "op3_decontaminate": decontaminate.ORACLE,
    "op4_substring_dedup": substring_dedup.ORACLE,
    "op6_mix": mixing.ORACLE,
    "op9_ngram_join": near_join.ORACLE,
    "op11_periodic_runs": periodic_runs.ORACLE,
    "op12_spelling": spelling.ORACLE,
    "op13_suffix_dedup": suffix_dedup.ORACLE,
}
