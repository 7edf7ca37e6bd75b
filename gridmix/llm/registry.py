"""Queries of this subpackage and the SQL that DuckDB runs against them; without SQL where SQL can't express one."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline

from gridmix.llm import collocations, decontam, mixing, packing, projections, quality, repeats, secrets, simhash, tokens, toxicity, warc, whitening

QUERIES: dict[str, Callable] = {
    "pipeline": corpus_pipeline.run,
    "op1_repeats": repeats.query,
    "op2_decontamination": decontam.query,
    "op3_toxicity": toxicity.query,
    "op4_secret_scan": secrets.query,
    "op5_token_counts": tokens.query,
    "op6_quality_rules": quality.query,
    "op7_simhash": simhash.query,
    "op8_packing": packing.query,
    "op9_language_model": mixing.query,
    "op10_warc": warc.query,
    "op11_whitening": whitening.query,
    "op12_embedding_duplicates": projections.query,
    "op13_collocations": collocations.query,
}
SQL: dict[str, str] = {"op2_decontamination": decontam.SQL, "op6_quality_rules": quality.SQL, "op10_warc": warc.SQL, "op12_embedding_duplicates": projections.SQL, "op13_collocations": collocations.SQL}
