"""Operators for language-model training text. Nothing outside this subpackage imports it."""

from __future__ import annotations


def queries():
    from quillwork.llm import registry

    return registry.queries()


def oracle_sql():
    from quillwork.llm import registry

    return registry.oracle_sql()
