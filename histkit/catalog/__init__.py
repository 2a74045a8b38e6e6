"""The query catalogue: every operator run over the given tables."""

from importlib import import_module

MODULES = ("event_queries", "history_queries", "merge_queries", "join_queries", "identity_queries", "identity_delta_queries", "quality_queries", "text_queries", "job_queries")


def load_all():
    """Import all query modules and return the registry they filled."""
    for name in MODULES:
        import_module(f"histkit.catalog.{name}")
    return import_module("histkit.catalog.registry")
