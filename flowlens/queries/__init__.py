"""Registered queries over the supplied tables."""

from importlib import import_module

MODULES = ("parts", "rows", "relational", "verdicts", "storage", "reports")


def load():
    """Registry with all query modules imported."""
    for m in MODULES:
        import_module(f"flowlens.queries.{m}")
    return import_module("flowlens.queries.registry")
