"""Registered queries by family, each beside the SQL it equals."""

from __future__ import annotations

from . import accounting_queries, depth_queries, governance_queries, grid_queries, layout_queries, primitive_queries, publication_queries, relational_queries, review_queries, vintage_queries

FAMILIES = (vintage_queries, accounting_queries, relational_queries, grid_queries, governance_queries, publication_queries, primitive_queries, review_queries, layout_queries, depth_queries)


def all_queries() -> dict:
    return {k: v for f in FAMILIES for k, v in f.queries().items()}


def all_oracles() -> dict:
    return {k: v for f in FAMILIES for k, v in f.oracle_sql().items()}
