"""Queries of this subpackage and the SQL that some of them equal."""

from __future__ import annotations

from .exact_search import exact_search_sql, op13_exact_search
from .fingerprints import op6_fingerprints
from .licenses import op10_licenses
from .near_duplicates import op4_ngram_join
from .mixing import mixing_sql, op1_mixing
from .nearest import op8_nearest
from .packing import op2_packing
from .phrases import collocations_sql, op11_collocations
from .pii import op9_pii
from .quality import op5_quality
from .runs import op12_runs
from .token_counts import op7_token_counts
from .token_store import op3_token_store

QUERIES = (op1_mixing, op2_packing, op3_token_store, op4_ngram_join, op5_quality, op6_fingerprints, op7_token_counts, op8_nearest, op9_pii, op10_licenses, op11_collocations, op12_runs, op13_exact_search)


def pipeline(spark, sf_dir):
    """Every stage of corpus_pipeline.py, one after another."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    return {f.__name__: f for f in (*QUERIES, pipeline)}


def oracle_sql() -> dict:
    return {"op1_mixing": mixing_sql(), "op11_collocations": collocations_sql(), "op13_exact_search": exact_search_sql()}
