"""Queries of the core and their SQL."""

from __future__ import annotations

from quillwork.plans import audit_queries, curation_queries, distil_queries, document_queries, greedy_queries, lesson_queries, oracles, pack_queries, relational_queries, scalar_queries
from quillwork.plans.base import oracle_of, queries_of
from quillwork.streaming import audit as stream_queries

SQL = scalar_queries.QUERIES | pack_queries.QUERIES | relational_queries.QUERIES | document_queries.QUERIES | lesson_queries.QUERIES | distil_queries.QUERIES


def queries():
    return queries_of(SQL) | audit_queries.QUERIES | curation_queries.QUERIES | greedy_queries.QUERIES | stream_queries.QUERIES


def oracle_sql():
    return oracle_of(SQL) | oracles.SQL
