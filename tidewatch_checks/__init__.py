"""Registered queries: every operator run over the given tables, next to the same result in plain SQL."""

MODULES = (
    "drift_queries",
    "quality_queries",
    "label_queries",
    "ops_queries",
    "prep_queries",
    "source_queries",
    "stream_queries",
    "trend_queries",
)


def load_all() -> None:
    """Import every query module, which registers its queries."""
    from importlib import import_module

    for name in MODULES:
        import_module(f"tidewatch_checks.{name}")
