"""Registered queries and their expected results."""

from importlib import import_module

MODULES = ("gold_queries", "analytics_queries", "document_queries", "operator_queries", "quality_queries")


def load():
    from . import registry
    for name in MODULES:
        import_module(f"{__name__}.{name}")
    return registry.QUERIES, registry.ORACLE
